import pytest
from pyspark.sql import functions as F

from opinara import jobs
from opinara.__main__ import main, parser
from opinara.catalog.tables import upstream_reviews
from opinara.operators.runs import read_log
from opinara.plans import studies
from opinara.plans.models import load_model
from opinara.plans.studies import RunSpec
from opinara.settings import FeatureSettings, SourceSettings

SETTINGS = FeatureSettings(vocab_size=300, min_df=3)


@pytest.fixture(scope="module")
def paths(spark, small_dir, tmp_path_factory):
    """Both splits, conformed from the upstream layout by the job itself."""
    folder = tmp_path_factory.mktemp("reviews")
    upstream = upstream_reviews(spark, small_dir).drop("doc_id").repartition(4)
    for name in ("train", "test"):
        raw, out = str(folder / f"{name}-raw"), str(folder / f"{name}.parquet")
        upstream.write.parquet(raw)
        main(["conform", "--source", raw, "--out", out, "--expect", "87"])
    return folder


def test_conform_checks_the_count(spark, paths):
    with pytest.raises(ValueError, match="Expected 5 rows, got 87"):
        jobs.conform_job(spark, str(paths / "train-raw"), str(paths / "never"), expected=5)


def test_jobs_from_end_to_end(spark, paths, tmp_path, monkeypatch):
    sources = SourceSettings(str(paths / "train.parquet"), str(paths / "test.parquet"))
    specs = [
        RunSpec("naive_bayes", "tfidf", FeatureSettings(vocab_size=4, min_df=3)),
        RunSpec("logistic_regression", "count_vectorizer", SETTINGS),
    ]
    overrides = {"logistic_regression": {"maxIter": 15}}
    written = jobs.train_job(spark, sources, str(tmp_path / "train"), specs, overrides)
    assert not spark.read.parquet(written["failed"]).collect()
    assert spark.read.json(written["runs"]).count() == 2
    log = {row.run_id: row for row in read_log(spark, written["log"]).collect()}
    names = [spec.run_id(overrides.get(spec.model)) for spec in specs]
    assert sorted(log) == sorted(names)
    assert all(load_model(row.artifacts[0]) for row in log.values())
    assert [len(row.artifacts) for row in log.values() if row.artifacts[0] == written["model"]] == [3]
    # Started again, it finds all it has done.
    monkeypatch.setattr(studies, "classifier", None)
    again = jobs.train_job(spark, sources, str(tmp_path / "train"), specs, overrides)
    assert again == written and spark.read.json(again["runs"]).count() == 2
    best = spark.read.parquet(written["metrics"]).first()
    shown = spark.read.parquet(written["comparison"]).orderBy(F.desc("accuracy")).first()
    assert shown.accuracy == f"{best.accuracy:.4f}"

    common = ["--train", sources.train_path, "--test", sources.test_path]
    again = main(["errors", *common, "--model", written["model"], "--out", str(tmp_path / "errors")])
    assert spark.read.parquet(again["metrics"]).first() == best
    total = spark.read.parquet(again["overview"]).first().total
    assert spark.read.parquet(again["accuracy_by_length"]).agg(F.sum("cnt")).first()[0] == 87
    wrong = spark.read.parquet(again["false_positives"]).collect()
    assert all(0 < len(row.preview) <= 300 for row in wrong)
    assert spark.read.parquet(again["confidence"]).agg(F.sum("cnt")).first()[0] == total == 87

    exported = main(["export", "--model", written["model"], "--out", str(tmp_path / "export")])
    assert spark.read.parquet(exported["weights"]).filter("idx = -1").count() == 1


def test_profile_job(spark, paths, tmp_path):
    out = main(["profile", "--train", str(paths / "train.parquet"), "--test", str(paths / "test.parquet"),
                "--out", str(tmp_path / "profile")])
    assert spark.read.parquet(out["class_distribution"]).agg(F.sum("cnt")).first()[0] == 174
    assert spark.read.parquet(out["summary"]).count() == 4
    assert spark.read.parquet(out["char_length"]).agg(F.sum("cnt")).first()[0] == 87


def test_profile_job_reads_the_texts_once(spark, paths, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counting(df):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    sources = SourceSettings(str(paths / "train.parquet"), str(paths / "test.parquet"))
    plain = jobs.profile_job(spark, sources, str(tmp_path / "plain"))
    real = jobs.load_splits
    monkeypatch.setattr(jobs, "load_splits", lambda *given: tuple(map(counting, real(*given))))
    counted = jobs.profile_job(spark, sources, str(tmp_path / "counted"))
    assert seen.value == 174
    for name in plain:
        one, two = (sorted(map(str, spark.read.parquet(paths_[name]).collect())) for paths_ in (plain, counted))
        assert one == two and one


def test_scaling_job(spark, paths, tmp_path):
    sources = SourceSettings(str(paths / "train.parquet"), str(paths / "test.parquet"))
    out = jobs.scaling_job(spark, sources, str(tmp_path / "scaling"), fractions=(1.0,))
    assert spark.read.parquet(out["scaling"]).first().n_rows == 87
    assert spark.read.json(out["scaling_json"]).first().n_rows == 87


def test_arguments():
    given = parser().parse_args(["train", "--out", "x", "--vocab-size", "99", "--tree-vocab-size", "7"])
    assert (given.fraction, given.vocab_size, given.min_df, given.ngram, given.tree_vocab_size) == (1.0, 99, 5, 2, 7)
    assert parser().parse_args(["scaling", "--out", "x"]).vocab_size == 65_536
    with pytest.raises(SystemExit):
        parser().parse_args(["errors", "--out", "x"])
