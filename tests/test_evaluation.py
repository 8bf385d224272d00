import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from opinara.operators import curves, errors, metrics


def predictions(spark, rows):
    df = spark.createDataFrame(rows, "id long, label double, prob double")
    return df.withColumn("prediction", F.when(F.col("prob") >= 0.5, 1.0).otherwise(0.0))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score, another third lie within 1e-9 of 1."""
    random.seed(7)
    rows = []
    for i in range(1500):
        prob = (0.5, 1.0 - random.randrange(1, 400) * 1e-12, random.random())[i % 3]
        rows.append((i, float(random.random() < 0.3 + prob / 2), prob))
    return predictions(spark, rows).repartition(6).cache()


def brute_points(df):
    rows = [(r.prob, r.label) for r in df.collect()]
    positives = sum(label for _, label in rows)
    negatives = len(rows) - positives
    points = []
    for score in sorted({score for score, _ in rows}, reverse=True):
        tp = sum(label for s, label in rows if s >= score)
        fp = sum(1 - label for s, label in rows if s >= score)
        points.append((score, fp / negatives, tp / positives, tp / (tp + fp)))
    return points


@pytest.mark.parametrize("slices", [2, 7, 2048])
def test_running_sums_do_not_depend_on_slices(skewed, slices):
    ranked = curves.ranked_counts(skewed, slices=slices).orderBy(F.desc("score")).collect()
    got = [
        (r.score, r.neg_upto / r.negatives, r.pos_upto / r.positives, r.pos_upto / (r.pos_upto + r.neg_upto))
        for r in ranked
    ]
    assert got == brute_points(skewed)


def test_curve_points_start_where_they_should(skewed):
    roc = curves.roc_points(skewed).orderBy(F.desc_nulls_first("threshold")).collect()
    assert tuple(roc[0]) == (None, 0.0, 0.0) and tuple(roc[-1])[1:] == (1.0, 1.0)
    assert [tuple(r) for r in roc[1:]] == [p[:3] for p in brute_points(skewed)]
    pr = curves.pr_points(skewed).orderBy(F.desc_nulls_first("threshold")).collect()
    assert tuple(pr[0]) == (None, 1.0, 0.0)
    assert [(r.recall, r.precision) for r in pr[1:]] == [p[2:] for p in brute_points(skewed)]


def test_auc_equals_the_builtin_evaluator(skewed):
    builtin = BinaryClassificationEvaluator(rawPredictionCol="prob", numBins=0).evaluate(skewed)
    assert curves.auc(skewed).first().auc == pytest.approx(builtin, abs=1e-12)


def test_average_precision(skewed):
    before, expected = 0.0, 0.0
    for _, _, recall, precision in brute_points(skewed):
        expected += (recall - before) * precision
        before = recall
    assert curves.average_precision(skewed).first()[0] == pytest.approx(expected, abs=1e-12)


def test_metrics_equal_the_builtin_evaluators(skewed):
    got = metrics.classification_metrics(skewed).first()
    for name, builtin in {
        "accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"
    }.items():
        expected = MulticlassClassificationEvaluator(metricName=builtin).evaluate(skewed)
        assert got[name] == pytest.approx(expected, abs=1e-12)
    assert metrics.classification_metrics(skewed, score=None).first().auc is None


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_one_class_has_no_auc(spark, label):
    df = predictions(spark, [(i, label, i / 10) for i in range(10)])
    got = metrics.classification_metrics(df).first()
    assert got.auc is None
    assert got.accuracy == pytest.approx(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df))
    assert got.f1 == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(df))
    rates = {(r.fpr is None, r.tpr is None) for r in curves.roc_points(df).collect()}
    assert rates == {(False, False), (label == 1, label == 0)}
    assert (curves.average_precision(df).first()[0] is None) == (label == 0)


def test_runs_are_evaluated_side_by_side(skewed):
    both = skewed.withColumn("run", F.lit("a")).unionByName(
        skewed.withColumn("run", F.lit("b")).withColumn("prob", 1 - F.col("prob"))
    )
    got = {r.run: r.auc for r in metrics.classification_metrics(both, by=("run",)).collect()}
    assert got["a"] == pytest.approx(curves.auc(skewed).first().auc)
    assert got["a"] + got["b"] == pytest.approx(1.0)


def test_confusion_has_all_cells(spark):
    cells = metrics.confusion(predictions(spark, [(1, 1.0, 0.9), (2, 1.0, 0.8)])).collect()
    assert {(r.label, r.prediction): r.cnt for r in cells} == {
        (0.0, 0.0): 0, (0.0, 1.0): 0, (1.0, 0.0): 0, (1.0, 1.0): 2
    }


def test_top_errors_break_ties_by_key(spark):
    rows = [(i, 0.0, 0.9) for i in range(30)] + [(100, 0.0, 0.95), (101, 1.0, 0.1)]
    df = predictions(spark, rows).withColumn("combined_text", F.lit("x" * 500)).repartition(4)
    top = errors.top_errors(df, "fp", "id", 3).collect()
    assert [r.id for r in top] == [100, 0, 1]
    assert {len(r.preview) for r in top} == {300}
    assert [r.id for r in errors.top_errors(df, "fn", "id").collect()] == [101]
    assert errors.correct_rows(df).count() == 0
    with pytest.raises(ValueError, match="Unknown kind"):
        errors.top_errors(df, "tp", "id")


def test_nothing_to_evaluate(spark):
    df = predictions(spark, [(1, 1.0, 0.9)]).limit(0)
    assert tuple(metrics.error_overview(df).first()) == (0, 0, 0, None, None)
    assert metrics.accuracy_by_length(df.withColumn("combined_text", F.lit(""))).count() == 0
    assert metrics.confusion(df).agg(F.sum("cnt")).first()[0] == 0
    assert curves.roc_points(df).count() == 1


def test_rows_without_a_score_count(spark):
    rows = [(1.0, 1.0, 0.9), (0.0, 0.0, 0.2), (1.0, 0.0, None), (0.0, 1.0, float("nan")), (1.0, 1.0, 0.2)]
    df = spark.createDataFrame(rows, "label double, prediction double, prob double")
    measured = metrics.classification_metrics(df).first()
    assert measured.accuracy == pytest.approx(0.6)
    # Positives at 0.9, 0.2 and unscored, negatives at 0.2 and unscored: 4 of 6 pairs right, ties half.
    assert measured.auc == pytest.approx((2 + 1.5 + 0.5) / 6)
    points = sorted((p.fpr, p.tpr) for p in curves.roc_points(df).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0) and len(points) == 4
    assert curves.pr_points(df).agg({"recall": "max"}).first()[0] == 1.0


def test_a_group_named_by_a_null_counts(spark):
    rows = [(None, 1.0, 1.0, 0.9), (None, 0.0, 0.0, 0.1), ("a", 1.0, 0.0, 0.4)]
    df = spark.createDataFrame(rows, "run string, label double, prediction double, prob double")
    found = {r.run: r.accuracy for r in metrics.classification_metrics(df, by=("run",)).collect()}
    assert found == {None: 1.0, "a": 0.0}


GAPS = [
    (1, 1.0, 1.0, 0.9), (2, 0.0, 1.0, None), (3, 0.0, 1.0, float("nan")), (4, 0.0, 1.0, 0.7), (5, 0.0, 1.0, 0.95),
    (6, 1.0, None, 0.5), (7, 0.0, None, None), (8, None, 1.0, 0.4), (9, 1.0, 0.0, None), (10, 1.0, 0.0, 0.2),
    (11, float("nan"), 0.0, 0.3), (12, 1.0, float("nan"), 0.6),
]


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([(*row, "x" * row[0]) for row in GAPS], "id int, label double, prediction double, prob double, combined_text string")


def test_all_metrics_count_the_same_rows(gaps):
    """Ten rows have a label; three of them have no prediction and are wrong."""
    cells = {(r.label, r.prediction): r.cnt for r in metrics.confusion(gaps).collect()}
    assert cells == {(0.0, 0.0): 0, (0.0, 1.0): 5, (1.0, 0.0): 4, (1.0, 1.0): 1}
    overview = metrics.error_overview(gaps).first()
    assert (overview.total, overview.correct) == (10, 1)
    assert metrics.classification_metrics(gaps).first().accuracy == pytest.approx(0.1)
    assert metrics.classification_metrics(gaps, score=None).first().accuracy == pytest.approx(0.1)
    by_length = metrics.accuracy_by_length(gaps).first()
    assert (by_length.cnt, by_length.accuracy) == (10, pytest.approx(0.1))
    bins = {r.bin: r.cnt for r in metrics.confidence_histogram(gaps, bins=2).filter("is_correct = 0").collect()}
    assert bins[-1] == 4 and sum(bins.values()) == 9


def test_rows_without_score_are_no_confident_errors(gaps):
    listed = [r.id for r in errors.top_errors(gaps, "fp", "id").collect()]
    assert listed == [5, 4, 2, 3] and [r.id for r in errors.top_errors(gaps, "fp", "id", k=2).collect()] == [5, 4]
    assert [r.id for r in errors.top_errors(gaps, "fn", "id").collect()] == [10, 9]
