"""Exact ROC and precision-recall curves without a global sort.

A running sum over the whole score order would put every score on one task. Instead equal
scores are merged first, the distinct scores are cut into slices of about equal size, sums run
within a slice, and the totals of the slices above are added. The cut points come from an
approximate quantile, which decides only how even the slices are, never the result.

A row without a score (null or NaN) counts like any other: it ranks below every score, under the
threshold minus infinity.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.session import materialize

SLICES = 2048
INFINITY = float("inf")


def score_counts(df: DataFrame, score: str = "prob", by: tuple[str, ...] = ()) -> DataFrame:
    """Per distinct score: rows of each class, and how many of them are predicted positive."""
    positive, predicted = F.col("label") == 1, F.col("prediction") == 1
    value = F.col(score).cast("double")
    value = F.when(value.isNull() | F.isnan(value), F.lit(-INFINITY)).otherwise(value)
    cells = {"tn": ~positive & ~predicted, "fn": positive & ~predicted}
    cells |= {"fp": ~positive & predicted, "tp": positive & predicted}
    return df.groupBy(*by, value.alias("score")).agg(
        *[F.count(F.when(cell, 1)).alias(name) for name, cell in cells.items()]
    )


def _sliced(counts: DataFrame, slices: int) -> DataFrame:
    shares = [i / slices for i in range(1, slices)]
    cuts = {cut for cut in counts.approxQuantile("score", shares, 0.25 / slices) if abs(cut) < INFINITY}
    cuts = sorted(cuts) or [0.5]
    slicer = Bucketizer(splits=[-INFINITY, *cuts, INFINITY], inputCol="score", outputCol="slice")
    return slicer.transform(counts)


def ranked_counts(
    df: DataFrame, score: str = "prob", by: tuple[str, ...] = (), slices: int = SLICES
) -> DataFrame:
    """Distinct scores with the rows of each class at or above them, and the class totals."""
    # Read twice below (quantiles, then sums), and the predictions may be costly to repeat.
    counts = materialize(score_counts(df, score, by))
    counts = _sliced(counts, slices).withColumns(
        {"pos": F.col("tp") + F.col("fn"), "neg": F.col("tn") + F.col("fp")}
    )
    down = Window.partitionBy(*by).orderBy(F.desc("slice"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    # One row per slice (and group), so these windows stay small.
    offsets = (
        counts.groupBy(*by, "slice")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            *by,
            "slice",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_before"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("neg_before"),
            F.sum("p").over(whole).alias("positives"),
            F.sum("n").over(whole).alias("negatives"),
        )
    )
    within = Window.partitionBy(*by, "slice").orderBy(F.desc("score"))
    run = counts.withColumns({"pos_run": F.sum("pos").over(within), "neg_run": F.sum("neg").over(within)})
    keys = (*by, "slice")
    offsets = offsets.withColumnsRenamed({c: f"of_{c}" for c in keys})
    # Null-safe: a group may be named by a null.
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in keys))
    return (
        run.join(offsets, same)
        .select(
            *by,
            "score",
            *("tp", "fp", "tn", "fn", "pos", "neg"),
            (F.col("pos_before") + F.col("pos_run")).alias("pos_upto"),
            (F.col("neg_before") + F.col("neg_run")).alias("neg_upto"),
            "positives",
            "negatives",
        )
    )


def auc_sum() -> Column:
    """Share of (positive, negative) pairs ranked right, ties counting half.

    DOUBLE products: a BIGINT one overflows from about 3 * 10^9 rows per class on.
    """
    below = F.col("negatives") - F.col("neg_upto") + 0.5 * F.col("neg")
    pairs = F.first("positives").cast("double") * F.first("negatives").cast("double")
    return F.sum(F.col("pos").cast("double") * below) / F.when(pairs > 0, pairs)


def auc(df: DataFrame, score: str = "prob", by: tuple[str, ...] = ()) -> DataFrame:
    """Area under the ROC curve; NULL where a class is missing."""
    return ranked_counts(df, score, by).groupBy(*by).agg(auc_sum().alias("auc"))


def _with_start(df: DataFrame, points: DataFrame, **start: float) -> DataFrame:
    first = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        *[F.lit(value).alias(name) for name, value in start.items()],
    )
    return first.unionByName(points)


def roc_points(df: DataFrame, score: str = "prob", ranked: DataFrame | None = None) -> DataFrame:
    """False and true positive rate at every distinct score, after the start at (0, 0).

    A rate over a class without rows is NULL.
    """
    ranked = ranked_counts(df, score) if ranked is None else ranked
    points = ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide("neg_upto", "negatives").alias("fpr"),
        F.try_divide("pos_upto", "positives").alias("tpr"),
    )
    return _with_start(df, points, fpr=0.0, tpr=0.0)


def pr_points(df: DataFrame, score: str = "prob", ranked: DataFrame | None = None) -> DataFrame:
    """Precision and recall at every distinct score, after the start at precision 1, recall 0."""
    ranked = ranked_counts(df, score) if ranked is None else ranked
    points = ranked.select(
        F.col("score").alias("threshold"),
        (F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))).alias("precision"),
        F.try_divide("pos_upto", "positives").alias("recall"),
    )
    return _with_start(df, points, precision=1.0, recall=0.0)


def average_precision(df: DataFrame, score: str = "prob", ranked: DataFrame | None = None) -> DataFrame:
    """Precision summed over falling scores, weighted by the recall each score adds."""
    gained = F.try_divide("pos", "positives")
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    ranked = ranked_counts(df, score) if ranked is None else ranked
    return ranked.agg(F.sum(gained * precision).alias("average_precision"))
