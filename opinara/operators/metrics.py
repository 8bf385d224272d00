"""Confusion matrix and classification metrics for two classes.

One rule holds for all of them: a row without a label (null or NaN) cannot be judged and is left out; a row
with a label but without a prediction counts as predicted to be of the other class. A missing score
changes neither; the curves rank it last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opinara.functions.predictions import is_correct
from opinara.functions.text import length_bucket, length_bucket_no
from opinara.operators.curves import auc_sum, ranked_counts, score_counts
from opinara.operators.profile import histogram

CONFIDENCE_BINS = 50


def judged(df: DataFrame) -> DataFrame:
    """The rows that count, each with a prediction."""
    label, prediction = F.col("label"), F.col("prediction")
    missing = prediction.isNull() | F.isnan(prediction.cast("double"))
    known = df.filter(label.isNotNull() & ~F.isnan(label.cast("double")))
    return known.withColumn("prediction", F.when(missing, F.when(label == 1, 0).otherwise(1)).otherwise(prediction).cast("double"))


def confusion(df: DataFrame) -> DataFrame:
    """All four cells, in one pass, absent ones as zero."""
    df = judged(df)
    label, prediction = F.col("label"), F.col("prediction")
    cells = [(actual, predicted) for actual in (0.0, 1.0) for predicted in (0.0, 1.0)]
    counted = df.agg(
        *[
            F.count(F.when((label == actual) & (prediction == predicted), 1)).alias(f"c{i}")
            for i, (actual, predicted) in enumerate(cells)
        ]
    )
    entries = [
        F.struct(
            F.lit(actual).alias("label"), F.lit(predicted).alias("prediction"), F.col(f"c{i}").alias("cnt")
        )
        for i, (actual, predicted) in enumerate(cells)
    ]
    return counted.select(F.inline(F.array(*entries)))


def _ratio(part: Column, whole: Column) -> Column:
    """Share as DOUBLE, zero where the whole is empty."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _weighted_metrics() -> dict[str, Column]:
    """Accuracy and support-weighted precision, recall and F1 from columns tp, fp, tn, fn."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rows = tp + fp + tn + fn
    classes = ((tp, tp + fn, tp + fp), (tn, tn + fp, tn + fn))  # hits, support, predicted
    precision = recall = f1 = F.lit(0.0)
    for hits, support, predicted in classes:
        weight = _ratio(support, rows)
        class_precision, class_recall = _ratio(hits, predicted), _ratio(hits, support)
        precision += weight * class_precision
        recall += weight * class_recall
        f1 += weight * _ratio(
            2.0 * class_precision * class_recall, class_precision + class_recall
        )
    return {"accuracy": _ratio(tp + tn, rows), "precision": precision, "recall": recall, "f1": f1}


def classification_metrics(
    df: DataFrame, score: str | None = "prob", by: tuple[str, ...] = (), ranked: DataFrame | None = None
) -> DataFrame:
    """Accuracy, weighted precision, recall, F1 and, given a score, the exact AUC.

    Every row counts, whether it has a score or not. ``ranked`` hands over ranked counts already made. One pass over the predictions; ``by`` evaluates several runs side by side.
    """
    totals = [F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")]
    df = judged(df)
    if score is None:
        counted = score_counts(df.withColumn("_no_score", F.lit(0.0)), "_no_score", by)
        counted = counted.groupBy(*by).agg(*totals)
        area = F.lit(None).cast("double")
    else:
        ranked = ranked_counts(df, score, by) if ranked is None else ranked
        counted = ranked.groupBy(*by).agg(*totals, auc_sum().alias("auc"))
        area = F.col("auc")
    metrics = [value.alias(name) for name, value in _weighted_metrics().items()]
    return counted.select(*by, *metrics, area.alias("auc"))


def correct_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("is_correct", is_correct())


def error_overview(df: DataFrame) -> DataFrame:
    """Rows, right and wrong predictions, and both shares in percent."""
    counted = correct_flags(judged(df)).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("is_correct") == 1).alias("correct")
    )
    incorrect = F.col("total") - F.col("correct")
    return counted.select(
        "total",
        "correct",
        incorrect.alias("incorrect"),
        F.try_divide(100.0 * F.col("correct"), F.col("total")).alias("correct_pct"),
        F.try_divide(100.0 * incorrect, F.col("total")).alias("incorrect_pct"),
    )


def accuracy_by_length(
    df: DataFrame, text: str = "combined_text", length: str | None = None
) -> DataFrame:
    """Accuracy per length bucket, shortest first; ``length`` names a column already counted."""
    length = F.col(length) if length else F.length(text)
    return (
        correct_flags(judged(df))
        .groupBy(length_bucket_no(length).alias("bucket_no"), length_bucket(length).alias("length_bucket"))
        .agg(F.avg(F.col("is_correct").cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("cnt"))
        .orderBy("bucket_no")
    )


def confidence_histogram(df: DataFrame, score: str = "prob", bins: int = CONFIDENCE_BINS) -> DataFrame:
    """Positive probability of right and of wrong predictions, each over its own range of numbers.

    Rows without a score are counted in bin -1.
    """
    return histogram(correct_flags(judged(df)), score, bins, "is_correct", (0, 1))
