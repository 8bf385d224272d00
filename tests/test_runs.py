import json
from pathlib import Path

from pyspark.sql import functions as F

from opinara.operators import runs as r

ROWS = [
    (0, "lr", "cv", 0.9017, 0.9, 0.9, 0.9015, 0.9616, 120.5, None),
    (1, "gbt", "cv", 0.88, None, None, 0.87, None, 300.0, None),
    (2, "nb", "cv", None, None, None, None, None, None, "failed"),
    (3, "lr", "tfidf", 0.9017, 0.9, 0.9, 0.9, 0.95, 60.24, None),
]


def table(spark):
    return spark.createDataFrame(ROWS, r.RUNS_SCHEMA)


def test_comparison_formats(spark):
    rows = {(x.model, x.feature_type): x for x in r.comparison(r.valid_runs(table(spark))).collect()}
    assert len(rows) == 3
    assert rows["lr", "cv"].accuracy == "0.9017" and rows["lr", "cv"].training_time == "120.5s"
    assert rows["lr", "cv"].auc == "0.9616" and rows["gbt", "cv"].auc == "N/A"
    assert rows["lr", "tfidf"].training_time == "60.2s"
    assert r.comparison(table(spark)).filter("model = 'nb'").first().training_time == "N/A"


def test_best_run_is_the_first_of_equals(spark):
    assert r.best_run(table(spark).repartition(3)).first().seq == 0


def test_series_leave_out_what_is_missing(spark):
    got = {(x.run, x.metric): x.value for x in r.comparison_series(table(spark)).collect()}
    assert got["gbt + cv", "f1"] == 0.87 and len(got) == 6


def test_metric_table(spark):
    got = {x.metric: x for x in r.metric_table(table(spark), ["lr + cv", "gbt + cv"]).collect()}
    assert got["accuracy"]["lr + cv"] == 0.9017 and got["auc"]["gbt + cv"] is None


def test_json_holds_valid_runs_only(spark, tmp_path):
    path = r.write_runs_json(table(spark).coalesce(1), str(tmp_path / "runs"))
    lines = [json.loads(x) for f in Path(path).glob("*.json") for x in f.read_text().splitlines()]
    assert sorted(x["seq"] for x in lines) == [0, 1, 3]
    assert r.read_runs_json(spark, path).filter("seq = 1").first().auc is None


def test_log_keeps_runs_and_cleans(spark, tmp_path):
    path = str(tmp_path / "log")
    r.log_run(spark, path, "a", "m", "f", {"lr": 2e-5}, {"eval_f1": 0.5, "auc": None, "note": "x"}, 3.0, ["p.png"])
    r.put_log(r.log_entries(table(spark).filter("seq = 1"), {"vocab_size": 10}), path)
    log = {x.run_name: x for x in r.read_log(spark, path).collect()}
    assert log["a"].metrics == {"f1": 0.5, "training_time_seconds": 3.0}
    assert log["a"].params == {"model_name": "m", "feature_type": "f", "lr": "2e-05"}
    assert log["a"].artifacts == ["p.png"]
    assert log["gbt_cv"].metrics == {"accuracy": 0.88, "f1": 0.87, "training_time_seconds": 300.0}
    assert log["gbt_cv"].params["vocab_size"] == "10"


def test_logging_again_replaces_one_run_only(spark, tmp_path):
    path = str(tmp_path / "log")
    valid = r.valid_runs(table(spark))
    for _ in range(2):
        r.put_log(r.log_entries(valid, {"vocab_size": 10}), path)
    r.put_log(r.log_entries(valid.filter("seq = 0"), {"vocab_size": 99}), path)  # other work, so another run
    better = valid.filter("seq = 3").withColumn("accuracy", F.lit(0.95))
    r.put_log(r.log_entries(better, {"vocab_size": 10}, ["model"]), path)
    log = {x.run_id: x for x in r.read_log(spark, path).collect()}
    assert r.read_log(spark, path).count() == len(log) == 4
    assert log[r.run_id("lr", "tfidf", {"vocab_size": 10})].metrics["accuracy"] == 0.95
    assert log[r.run_id("lr", "tfidf", {"vocab_size": 10})].artifacts == ["model"]
    assert log[r.run_id("lr", "cv", {"vocab_size": 99})].metrics["accuracy"] == 0.9017


def test_runs_are_known_by_their_work(spark, tmp_path):
    assert r.run_id("m", "f", {"a": 1, "b": 2}) == r.run_id("m", "f", {"b": "2", "a": "1"})
    assert len({r.run_id("m", "f"), r.run_id("m", "g"), r.run_id("m", "f", {"a": 1})}) == 3
    assert r.logged_runs(spark, str(tmp_path / "none"), ["x"]) == {}


def test_scaling_rows_as_json(spark, tmp_path):
    rows = [(0.1, 5, 1.0, 0.5, 5.0, None), (0.01, 1, None, None, None, "too small")]
    study = spark.createDataFrame(rows, "fraction double, n_rows long, training_time double, accuracy double, throughput double, error string")
    read = spark.read.schema(study.schema).json(r.write_scaling_json(study, str(tmp_path / "scaling")))
    assert sorted(map(tuple, read.collect())) == sorted(rows)


def test_run_names(spark):
    row = table(spark).select(r.run_name().alias("n"), r.run_label().alias("l"), F.lit(1)).first()
    assert (row.n, row.l) == ("lr_cv", "lr + cv")
