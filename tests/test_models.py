import shutil
import threading
from pathlib import Path

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, SQLTransformer
from pyspark.sql import functions as F

from oracle_check import compare, connect
from opinara.catalog.oracles import ORACLES
from opinara.catalog.queries import QUERIES
from opinara.catalog.tables import KEY, with_tokens
from opinara.operators import metrics
from opinara.operators.runs import METRICS, RUNS_SCHEMA, log_entries, logged_runs, put_log, read_log, valid_runs
from opinara.operators.sampling import hash_sample
from opinara.operators.weights import naive_bayes_margin, naive_bayes_weights, score_with_weights, weights_of
from opinara.plans import studies
from opinara.plans.features import PIPELINES, feature_stages, text_stages, weighting_stages
from opinara.plans.models import classifier, full_pipeline, load_model, save_model, score, weights_table
from opinara.session import fresh_path
from opinara.settings import FeatureSettings

SETTINGS = FeatureSettings(vocab_size=500, min_df=3)


def test_feature_pipelines_exist():
    assert list(PIPELINES) == ["count_vectorizer", "tfidf", "ngram_cv", "ngram_tfidf"]


@pytest.mark.parametrize("name, stages", [("count_vectorizer", 3), ("tfidf", 4), ("ngram_cv", 4), ("ngram_tfidf", 5)])
def test_feature_pipelines_have_their_stages(spark, name, stages):
    assert len(feature_stages(name)) == stages


def test_settings_reach_the_last_stage(spark):
    vectorizer = feature_stages("count_vectorizer", FeatureSettings(vocab_size=1000, min_df=2))[-1]
    assert (vectorizer.getVocabSize(), vectorizer.getMinDF()) == (1000, 2)


def test_unknown_names(spark):
    with pytest.raises(ValueError, match="Unknown feature type"):
        feature_stages("nothing")
    with pytest.raises(ValueError, match="Unknown model"):
        classifier("nothing")


def test_models_have_their_settings(spark):
    assert classifier("logistic_regression").getMaxIter() == 100
    assert classifier("naive_bayes").getSmoothing() == 1.0
    assert (classifier("random_forest").getNumTrees(), classifier("random_forest").getMaxDepth()) == (100, 10)
    assert (classifier("gbt").getMaxIter(), classifier("gbt").getMaxDepth()) == (50, 5)
    assert classifier("gbt", maxIter=2).getMaxIter() == 2


@pytest.fixture(scope="module")
def tokenized(small_reviews):
    return PipelineModel(stages=text_stages()).transform(small_reviews).cache()


@pytest.mark.parametrize("feature", ["count_vectorizer", "ngram_cv"])
def test_vocabulary_has_the_builtin_terms_in_stable_order(tokenized, feature):
    stages = weighting_stages(feature, FeatureSettings(min_df=3))
    data = stages[0].transform(tokenized) if len(stages) > 1 else tokenized
    ours = stages[-1].fit(data)
    builtin = CountVectorizer(
        inputCol=stages[-1].getInputCol(), outputCol="x", minDF=3, vocabSize=65_536
    ).fit(data)
    assert set(ours.vocabulary) == set(builtin.vocabulary)
    assert ours.vocabulary == stages[-1].fit(data.repartition(7)).vocabulary
    assert ours.getOutputCol() == "features"


def test_a_vocabulary_reads_the_texts_once(spark):
    """The counts of magnitudes and the terms above them come from one evaluation of the texts."""
    from opinara.operators.vocabulary import tfidf, vocabulary

    read = spark.sparkContext.accumulator(0)

    def tokens(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(i, ["a", "b", None, "a"][: i % 5]) for i in range(50)], "doc_id long, filtered_tokens array<string>")
    seen = docs.mapInArrow(tokens, docs.schema)
    got = [(r.term, r.cnt, r.df) for r in vocabulary(seen, min_df=1).orderBy("idx").collect()]
    assert got == [("a", 50, 40), ("b", 30, 30)] and read.value == 50
    # Once for the numbers, once for the occurrences.
    assert tfidf(seen, "doc_id", min_df=1).count() == 70 and read.value == 150


def test_no_term_is_an_error(tokenized):
    with pytest.raises(ValueError, match="No term"):
        weighting_stages("count_vectorizer", FeatureSettings(min_df=10_000))[-1].fit(tokenized)


def test_terms_with_line_breaks(spark):
    from opinara.plans.features import StableCountVectorizer

    df = spark.createDataFrame([(["a\nb", "c"],), (["c"],)], "t array<string>")
    model = StableCountVectorizer(inputCol="t", outputCol="v", minDF=1).fit(df)
    assert model.vocabulary == ["c", "a\nb"]


@pytest.mark.parametrize("feature", ["tfidf", "ngram_tfidf"])
def test_hashed_counts_add_up(tokenized, feature):
    from pyspark.ml.functions import vector_to_array

    stages = weighting_stages(feature, SETTINGS)[:-1]
    data = tokenized
    for stage in stages:
        data = stage.transform(data)
    source = stages[-1].getInputCol()
    added = F.aggregate(vector_to_array("raw_features"), F.lit(0.0), lambda a, b: a + b)
    assert data.filter(added != F.size(source)).count() == 0


@pytest.fixture(scope="module")
def logistic(small_reviews):
    return full_pipeline("count_vectorizer", "logistic_regression", SETTINGS, maxIter=10).fit(small_reviews)


def joined_difference(one, two):
    both = one.select(KEY, F.col("prob").alias("p1")).join(two.select(KEY, F.col("prob").alias("p2")), KEY)
    return both.count(), both.agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0]


def test_weights_table_scores_like_the_pipeline(spark, small_reviews, logistic):
    table = weights_table(spark, logistic)
    docs = with_tokens(small_reviews)
    batch = score(logistic, small_reviews, KEY)
    for terms in (500, 10**9):  # broadcast and joined
        rows, difference = joined_difference(batch, score_with_weights(docs, table, KEY, terms=terms))
        assert rows == small_reviews.count() and difference < 1e-12


def test_weights_table_of_bigrams(spark, small_reviews):
    model = full_pipeline("ngram_cv", "logistic_regression", SETTINGS, maxIter=2).fit(small_reviews)
    vocabulary = next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary
    table = weights_table(spark, model).orderBy("idx").collect()
    assert [r.term for r in table] == [None, *vocabulary]


def test_weights_table_needs_a_linear_model(spark, small_reviews):
    model = full_pipeline("count_vectorizer", "naive_bayes", SETTINGS).fit(small_reviews)
    with pytest.raises(ValueError, match="linear"):
        weights_table(spark, model)


def test_documents_without_known_terms_keep_the_intercept(spark):
    docs = spark.createDataFrame([(1, []), (2, ["x"]), (3, ["a", "a"])], "id int, filtered_tokens array<string>")
    scored = score_with_weights(docs, weights_of(spark, ["a"], [1.5], -1.0), "id").collect()
    assert {r.id: r.margin for r in scored} == {1: -1.0, 2: -1.0, 3: 2.0}


def test_naive_bayes_in_closed_form_equals_the_estimator(small_reviews):
    model = full_pipeline("count_vectorizer", "naive_bayes", SETTINGS).fit(small_reviews)
    docs = with_tokens(small_reviews)
    margin = naive_bayes_margin(naive_bayes_weights(docs, settings=SETTINGS))
    rows, difference = joined_difference(score(model, small_reviews, KEY), score_with_weights(docs, margin, KEY))
    assert rows == small_reviews.count() and difference < 1e-9


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_naive_bayes_of_one_class_equals_the_closed_form(spark, small_reviews, label):
    rows = small_reviews.withColumn("label", F.lit(label))
    model = full_pipeline("count_vectorizer", "naive_bayes", SETTINGS).fit(rows)
    docs = with_tokens(rows)
    wanted = score_with_weights(docs, naive_bayes_margin(naive_bayes_weights(docs, settings=SETTINGS)), KEY)
    for fitted in (model, load_model(save_model(model, fresh_path(spark, "test-model")))):
        count, difference = joined_difference(score(fitted, rows, KEY), wanted)
        assert count == rows.count() and difference < 1e-9


def test_saved_model_predicts_the_same(spark, small_reviews, logistic):
    path = save_model(logistic, fresh_path(spark, "test-model"))
    save_model(logistic, path)  # overwrites
    rows, difference = joined_difference(score(logistic, small_reviews, KEY), score(load_model(path), small_reviews, KEY))
    assert rows == small_reviews.count() and difference == 0


def test_default_grid_has_eight_runs():
    grid = studies.default_grid()
    assert len(grid) == len(set(grid)) == 8
    assert {s.settings.vocab_size for s in grid} == {65_536}
    few = studies.default_grid(trees=FeatureSettings(vocab_size=9))
    assert {s.model for s in few if s.settings.vocab_size == 9} == {"random_forest", "gbt"}


def test_grid_goes_on_after_a_failure(spark, small_reviews):
    specs = [
        studies.RunSpec("naive_bayes", "count_vectorizer", FeatureSettings(min_df=10_000)),
        studies.RunSpec("naive_bayes", "count_vectorizer", SETTINGS),
        studies.RunSpec("random_forest", "count_vectorizer", SETTINGS),
    ]
    train, test = (small_reviews.filter(F.col("split") == s) for s in ("train", "test"))
    seen = []
    result = studies.run_grid(
        spark, train, test, specs, KEY, {"random_forest": {"numTrees": 3, "maxDepth": 2}},
        lambda spec, row, model: seen.append((spec, row["seq"], model is None)),
    )
    runs = {r.seq: r for r in result.runs.collect()}
    assert runs[0].accuracy is None and "No term" in runs[0].error
    assert runs[1].error is None and runs[1].training_time > 0 and runs[2].accuracy > 0
    assert sorted(seq for _, seq, _ in seen) == [0, 1, 2]
    assert all(specs[seq] == spec and failed == (seq == 0) for spec, seq, failed in seen)
    best = max((1, 2), key=lambda seq: runs[seq].accuracy)
    assert result.best == specs[best]
    predictions = score(result.best_model, test, KEY, "label")
    assert metrics.classification_metrics(predictions).first().accuracy == runs[best].accuracy


def test_scaling_study(spark, small_reviews):
    train, test = (small_reviews.filter(F.col("split") == s) for s in ("train", "test"))
    study = studies.scaling_study(
        spark, train, test, KEY, (0.01, 0.25, 1.0), "naive_bayes", settings=SETTINGS
    ).cache()
    rows = {r.fraction: r for r in study.collect()}
    assert rows[1.0].n_rows == train.count()
    assert rows[1.0].throughput == pytest.approx(rows[1.0].n_rows / rows[1.0].training_time)
    summary = studies.scaling_summary(study).first()
    assert summary.accuracy_at_100_pct == rows[1.0].accuracy
    assert summary.accuracy_at_1_pct == rows[0.01].accuracy
    assert summary.peak_throughput == max(r.throughput or 0 for r in rows.values())


@pytest.mark.parametrize("name", ["scaling_nb", "scaling_summary"])
def test_a_failed_fraction_is_no_result(spark, small_dir, monkeypatch, name):
    """Small samples have no vocabulary, which is a result; then a job of the fourth fails, which is none."""
    fits, real = [], studies.full_pipeline

    def failing(*given):
        fits.append(given)
        broken = [SQLTransformer(statement="SELECT * FROM __THIS__ WHERE raise_error('job given up') IS NULL")]
        return Pipeline(stages=broken * (len(fits) == 4) + real(*given).getStages())

    monkeypatch.setattr(studies, "full_pipeline", failing)
    with pytest.raises(studies.FAILURES, match="job given up"):
        QUERIES[name](spark, small_dir)
    assert len(fits) == 4


@pytest.mark.parametrize("quality", [0, 1])
def test_scaling_nb_of_one_class_equals_sql(spark, small_dir, tmp_path, quality):
    folder = tmp_path / "one-class"
    folder.mkdir()
    shutil.copy(f"{small_dir}/documents.parquet", folder)
    labels = spark.read.parquet(f"{small_dir}/labels.parquet").withColumn("quality", F.lit(quality))
    labels.write.parquet(str(tmp_path / "labels"))
    shutil.copy(next(Path(tmp_path / "labels").glob("*.parquet")), folder / "labels.parquet")
    assert compare(QUERIES["scaling_nb"](spark, str(folder)), connect(folder), ORACLES["scaling_nb"]) == []


def test_nothing_tested_has_no_accuracy(spark, small_reviews):
    study = studies.scaling_study(
        spark, small_reviews, small_reviews.limit(0), KEY, (1.0,), "naive_bayes", settings=SETTINGS
    ).first()
    assert study.n_rows == small_reviews.count() and study.training_time > 0
    assert study.accuracy is None and study.error is None


NAIVE = [
    studies.RunSpec("naive_bayes", features, FeatureSettings(size, 3))
    for features, size in (("count_vectorizer", 500), ("count_vectorizer", 40), ("ngram_cv", 500), ("tfidf", 300))
]


@pytest.fixture(scope="module")
def halves(small_reviews):
    return [small_reviews.filter(F.col("split") == s) for s in ("train", "test")]


def rows_of(result):
    return [tuple(r[c] for c in ("seq", "model", "feature_type", *METRICS, "error")) for r in result.runs.orderBy("seq").collect()]


def test_runs_share_the_cluster(spark, halves, monkeypatch):
    """Two fits meet at a barrier, which neither could pass alone; each has jobs and a pool of its own."""
    barrier, pools = threading.Barrier(2, timeout=120), []
    real = studies.classifier

    def meeting(model, **overrides):
        barrier.wait()
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return real(model, **overrides)

    monkeypatch.setattr(studies, "classifier", meeting)
    together = studies.run_grid(spark, *halves, NAIVE, KEY, parallel=2)
    ids = [spec.run_id() for spec in NAIVE]
    assert sorted(pools) == sorted(ids)
    assert all(spark.sparkContext.statusTracker().getJobIdsForGroup(name) for name in ids)
    monkeypatch.setattr(studies, "classifier", real)
    assert rows_of(together) == rows_of(studies.run_grid(spark, *halves, NAIVE, KEY, parallel=1))


def test_equal_features_are_fitted_once(spark, halves, monkeypatch):
    fits = []
    real = studies.weighting_stages
    monkeypatch.setattr(studies, "weighting_stages", lambda *named: fits.append(named) or real(*named))
    specs = [studies.RunSpec("naive_bayes", "count_vectorizer", SETTINGS)] * 3
    studies.run_grid(spark, *halves, specs, KEY, {"naive_bayes": {"smoothing": 2.0}}, parallel=3)
    assert len(fits) == 1


def test_a_killed_study_goes_on(spark, halves, tmp_path):
    """A study that dies in its third run leaves two in the log; started again, it runs the others only."""
    path, calls = str(tmp_path / "log"), []

    def on_run(spec, row, model, dies_at=None):
        calls.append(row["seq"])
        if dies_at is not None and len(calls) > dies_at:
            raise KeyboardInterrupt
        put_log(log_entries(valid_runs(spark.createDataFrame([row], RUNS_SCHEMA)), spec.params()), path)

    with pytest.raises(KeyboardInterrupt):
        studies.run_grid(spark, *halves, NAIVE, KEY, on_run=lambda *a: on_run(*a, dies_at=2), parallel=1)
    assert calls == [0, 1, 2] and read_log(spark, path).count() == 2
    known = logged_runs(spark, path, [spec.run_id() for spec in NAIVE])
    calls.clear()
    result = studies.run_grid(spark, *halves, NAIVE, KEY, on_run=on_run, logged=known, parallel=1)
    assert calls == [2, 3] and read_log(spark, path).count() == 4
    whole = studies.run_grid(spark, *halves, NAIVE, KEY)
    assert rows_of(result) == rows_of(whole) and result.best == whole.best
    again = studies.run_grid(spark, *halves, NAIVE, KEY, logged=logged_runs(spark, path, [s.run_id() for s in NAIVE]))
    assert rows_of(again) == rows_of(whole) and (again.best, again.best_model) == (whole.best, None)


@pytest.mark.parametrize("fractions", [(0.1, 0.5, 1.0), (0.3, 0.6)])
def test_slices_are_the_nested_samples(spark, halves, fractions):
    path = studies.write_slices(halves[0], KEY, fractions)
    for number, fraction in enumerate(fractions):
        read = studies.read_slices(spark, path, number)
        wanted = hash_sample(halves[0], KEY, fraction).select("label", "combined_text")
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, wanted.collect()))
        plan = read._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters") :]
        assert "slice#" in filters and f"<= {number}" in filters[: filters.index("]", filters.index("slice"))]
        files = {row[0] for row in read.select("_metadata.file_path").distinct().collect()}
        assert {name.split("slice=")[1][0] for name in files} <= set(map(str, range(number + 1)))
