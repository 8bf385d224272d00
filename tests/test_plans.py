"""What plans and logs promise."""


import pytest

from opinara.catalog.queries import QUERIES
from opinara.operators.runs import log_entries, put_log, read_log
from opinara.operators.weights import naive_bayes_margin



@pytest.mark.parametrize("name", ["features_count_vectorizer", "features_ngram_cv", "features_tfidf"])
def test_slots_do_not_meet_in_one_task(spark, small_dir, name):
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    # The dense states are grouped by task number, and only then taken apart into slots.
    assert "hashpartitioning(_groupingexpression" in plan or "hashpartitioning(state" in plan
    assert "hashpartitioning(slot" in plan or "hashpartitioning(pos" in plan


def test_margin_of_an_empty_vocabulary_is_an_error(spark):
    empty = spark.createDataFrame([], "label double, idx int, term string, tf long, theta double, pi double")
    with pytest.raises(ValueError, match="vocabulary"):
        naive_bayes_margin(empty)


def test_log_names_parameters_and_artifacts(spark, tmp_path):
    runs = spark.createDataFrame(
        [(0, "m", "f", 0.5, 0.5, 0.5, 0.5, None, 1.0, None)],
        "seq int, model string, feature_type string, accuracy double, precision double, recall double, f1 double, "
        "auc double, training_time double, error string",
    )
    put_log(log_entries(runs, {"vocab_size": 9, "min_df": 5}, ["a/model"]), str(tmp_path / "log"))
    row = read_log(spark, str(tmp_path / "log")).first()
    assert row.params["vocab_size"] == "9" and row.params["min_df"] == "5" and row.artifacts == ["a/model"]
    assert "auc" not in row.metrics
