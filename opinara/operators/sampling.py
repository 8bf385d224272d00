"""Deterministic sampling and splitting.

Samples of a share of the rows are a filter on :func:`hash_rank`. Exact sizes come from one table, written in a
single pass over the rows: each row with its rank and an ordinal, the number it has in that table. All
counting, and the result, is read from there, so the rows given are evaluated once, and rows of equal
key, null ones too, are told apart by their ordinals.

The n-th row of a class is found in three steps of counting: by slices of the rank's range, by rank and
piece of the table within the slice, and by ordinal within that piece. So neither a class with most of
the rows nor a key that many rows share is ever gathered in one task.

What is written is all columns given. To sample wide rows, hand over their key and class and join the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.functions.ranks import RANK_BITS, below_fraction, hash_rank
from opinara.operators.vocabulary import small
from opinara.session import materialize, write_once
from opinara.settings import SEED

# 2^20 slices of the rank range: at 10^11 rows each holds about 10^5 of them.
SLICE_BITS = 20
# Of an ordinal, the bits that number the rows of one piece.
PIECE_BITS = 33
CLASS, RANK, ORDINAL = "__class", "__rank", "__ordinal"


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = SEED) -> DataFrame:
    """Bernoulli sample: the same rows under any partitioning, nested across fractions."""
    if fraction >= 1.0:
        return df
    return df.filter(below_fraction(hash_rank(key, seed), fraction))


def _ranked(df: DataFrame, key: str, seed: int, group: Column) -> DataFrame:
    ranked = df.select("*", group.alias(CLASS), hash_rank(key, seed).alias(RANK))
    return write_once(ranked.withColumn(ORDINAL, F.monotonically_increasing_id()), "ranked")


def _holding(counts: DataFrame, *order: str) -> DataFrame:
    """Of ``rows`` counted along ``order``, the entry of each class that holds the ``nth``; that becomes its place in it."""
    upto = F.sum("rows").over(Window.partitionBy(CLASS).orderBy(*order))
    found = counts.withColumn("before", upto - F.col("rows"))
    found = found.filter((F.col("before") < F.col("nth")) & (F.col("nth") <= F.col("before") + F.col("rows")))
    return found.select(CLASS, *order, (F.col("nth") - F.col("before")).alias("nth"))


def _cut(ranked: DataFrame, quota: Callable[[Column], Column]) -> DataFrame:
    """``class, cut_rank, cut_ordinal`` of the ``quota(rows)``-th row of each class; none for a quota of 0."""
    rows = ranked.select(CLASS, RANK, ORDINAL).withColumns(
        {"slice": F.shiftright(RANK, RANK_BITS - SLICE_BITS), "piece": F.shiftright(ORDINAL, PIECE_BITS)}
    )
    count = F.count(F.lit(1)).alias("rows")
    slices = rows.groupBy(CLASS, "slice").agg(count)
    total = F.sum("rows").over(Window.partitionBy(CLASS))
    slice_ = _holding(slices.withColumn("nth", quota(total)), "slice")
    pieces = _within(rows, slice_, "slice").groupBy(CLASS, RANK, "piece", "nth").agg(count)
    piece = _holding(pieces, RANK, "piece")
    place = F.row_number().over(Window.partitionBy(CLASS).orderBy(ORDINAL))
    last = _within(rows, piece, RANK, "piece").withColumn("place", place).filter(F.col("place") == F.col("nth"))
    return materialize(last.select(CLASS, F.col(RANK).alias("cut_rank"), F.col(ORDINAL).alias("cut_ordinal")))


def _within(rows: DataFrame, chosen: DataFrame, *on: str) -> DataFrame:
    """Rows of the entries chosen, one a class, with the ``nth`` of that class."""
    chosen = materialize(chosen)
    named = chosen.select(F.col("nth"), *[F.col(c).alias(f"{c}_chosen") for c in (CLASS, *on)])
    same = [F.col(c).eqNullSafe(F.col(f"{c}_chosen")) for c in (CLASS, *on)]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    return rows.join(small(named, chosen.count()), condition).drop(*[f"{c}_chosen" for c in (CLASS, *on)])


def _with_chosen(ranked: DataFrame, quota: Callable[[Column], Column]) -> DataFrame:
    """Add ``chosen``: whether a row is among the first ``quota(rows)`` of its class."""
    cut = _cut(ranked, quota)
    limits = cut.withColumnRenamed(CLASS, "cut_class")
    at = F.struct(F.col(RANK).alias("rank"), F.col(ORDINAL).alias("ordinal"))
    last = F.struct(F.col("cut_rank").alias("rank"), F.col("cut_ordinal").alias("ordinal"))
    joined = ranked.join(small(limits, cut.count()), F.col(CLASS).eqNullSafe(F.col("cut_class")), "left")
    chosen = F.col("cut_rank").isNotNull() & (at <= last)
    return joined.withColumn("chosen", chosen).drop("cut_class", "cut_rank", "cut_ordinal")


def sample_n(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows, or all of them if there are fewer."""
    ranked = _ranked(df, key, seed, F.lit(0))
    return _with_chosen(ranked, lambda rows: F.least(F.lit(n), rows)).filter("chosen").select(*df.columns)


def sample_per_class(df: DataFrame, key: str, n: int, label: str = "label", seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows of each class, or the whole class if it is smaller; rows without class are one."""
    ranked = _ranked(df, key, seed, F.col(label))
    return _with_chosen(ranked, lambda rows: F.least(F.lit(n), rows)).filter("chosen").select(*df.columns)


def stratified_split(
    df: DataFrame, key: str, fraction: float = 0.1, label: str = "label", seed: int = SEED
) -> DataFrame:
    """Add ``part``: the rounded ``fraction`` of each class becomes ``validation``, the rest ``train``."""
    ranked = _ranked(df, key, seed, F.col(label))
    parts = _with_chosen(ranked, lambda rows: F.round(rows * F.lit(fraction)).cast("bigint"))
    part = F.when(F.col("chosen"), "validation").otherwise("train").alias("part")
    return parts.select(*df.columns, part)
