"""The errors a model was most sure of."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opinara.functions.text import preview

TOP_ERRORS = 20


def correct_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label") == F.col("prediction"))


def false_positives(df: DataFrame) -> DataFrame:
    return df.filter((F.col("label") == 0) & (F.col("prediction") == 1))


def false_negatives(df: DataFrame) -> DataFrame:
    return df.filter((F.col("label") == 1) & (F.col("prediction") == 0))


def top_errors(
    df: DataFrame, kind: str, key: str, k: int = TOP_ERRORS, score: str = "prob",
    text: str = "combined_text",
) -> DataFrame:
    """The ``k`` most confident false positives (``fp``) or false negatives (``fn``).

    Rows without a score (null or NaN) come after all others. Ties go to the smaller key. Every task keeps its own ``k`` rows, so nothing is sorted whole.
    """
    if kind == "fp":
        wrong, order = false_positives(df), F.desc_nulls_last
    elif kind == "fn":
        wrong, order = false_negatives(df), F.asc_nulls_last
    else:
        raise ValueError(f"Unknown kind of error: {kind}. Choose fp or fn")
    number = F.when(~F.isnan(F.col(score).cast("double")), F.col(score))
    return (
        wrong.orderBy(order(number), key)
        .limit(k)
        .select(key, F.col(score).alias("confidence"), preview(F.col(text)).alias("preview"))
    )
