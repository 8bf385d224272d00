"""Data profile: counts, histograms, densities, summaries.

Lengths take few distinct values, so each profile first counts rows per value (one scan, combined before
the shuffle), writes that small table out and derives everything else from it. The table of one scan can
serve all profiles at once: counts of several measures, by class and split, and of words, side by side.

A value that is no number (null, NaN, infinite) belongs to no range: histograms count it in a bin of its own,
number -1 without a start, if there are any; summaries and densities leave it out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.functions.text import clip
from opinara.session import materialize

DENSITY_POINTS = 1000
QUARTILES = (0.25, 0.5, 0.75)
RANGE = 256  # values to a range when ranks are looked up
TERMS = "terms"  # the series of counted words
NO_NUMBER = -1  # the bin of values that are none


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("cnt"))


def class_distribution(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split, label).agg(F.count(F.lit(1)).alias("cnt")).orderBy(split, label)


def is_number(value: Column) -> Column:
    value = value.cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def value_counts(
    df: DataFrame, series: dict[str, Column], by: tuple[str, ...] = (), terms: Column | None = None
) -> DataFrame:
    """Rows per (series, value) for several measures in one scan, run at once.

    ``by`` counts them by these columns too. ``terms``, an array, counts its entries in the same scan, as the
    series ``TERMS`` with a ``term`` instead of a value.
    """
    nothing = F.lit(None).cast("string")
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("series"), F.when(is_number(measure), measure.cast("double")).alias("value"), nothing.alias("term"))
            for name, measure in series.items()
        ]
    )
    if terms is not None:
        none = F.lit(None).cast("double").alias("value")
        entries = F.concat(entries, F.transform(terms, lambda term: F.struct(F.lit(TERMS).alias("series"), none, term.alias("term"))))
    keys = (*by, "series", "value", *(("term",) if terms is not None else ()))
    return materialize(df.select(*by, F.inline(entries)).groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")))


def clipped(counts: DataFrame, measures: dict[str, tuple[str, int]]) -> DataFrame:
    """Counts of values cut at an upper bound, given as ``{series: (series counted, upper bound)}``."""
    value = F.when(F.col("value").isNotNull(), F.col("value"))
    cut = F.array(
        *[
            F.when(F.col("series") == source, F.struct(F.lit(name).alias("series"), F.when(value.isNotNull(), clip(value, upper)).alias("value")))
            for name, (source, upper) in measures.items()
        ]
    )
    return counts.select(F.inline(F.array_compact(cut)), "cnt").groupBy("series", "value").agg(F.sum("cnt").alias("cnt"))


def class_distribution_of_counts(counts: DataFrame, series: str, split: str = "split", label: str = "label") -> DataFrame:
    """Every row has one value in each measure's series, so any of these counts the rows."""
    return counts.filter(F.col("series") == series).groupBy(split, label).agg(F.sum("cnt").alias("cnt")).orderBy(split, label)


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    position = F.floor((value - low) / ((high - low) / F.lit(float(bins))))
    return F.when(is_number(value), F.least(position, F.lit(bins - 1))).otherwise(NO_NUMBER).cast("int")


def _widened(low: Column, high: Column) -> tuple[Column, Column]:
    """A single-valued range is widened by one half on each side."""
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def _with_empty_bins(filled: DataFrame, ranges: DataFrame, by: str, bins: int) -> DataFrame:
    """``filled`` holds the bins with rows, and in bin ``NO_NUMBER`` the rows without a number."""
    frame = ranges.filter(F.col("low").isNotNull()).select(
        by, "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    numbers = frame.join(filled, [by, "bin"], "left").select(
        by,
        "bin",
        F.round(F.col("low") + F.col("bin") * width, 6).alias("bin_start"),
        F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"),
    )
    others = filled.filter(F.col("bin") == NO_NUMBER)
    return numbers.unionByName(others.select(by, "bin", F.lit(None).cast("double").alias("bin_start"), F.col("cnt").cast("bigint")))


def histogram_of_counts(counts: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins over each series' own range, from :func:`value_counts`."""
    whole = Window.partitionBy("series")
    low, high = _widened(F.min("value").over(whole), F.max("value").over(whole))  # nulls are passed over
    placed = counts.withColumns({"low": low, "high": high})
    filled = placed.groupBy(
        "series", _bin_of(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin")
    ).agg(F.sum("cnt").alias("cnt"))
    ranges = placed.groupBy("series").agg(F.first("low").alias("low"), F.first("high").alias("high"))
    return _with_empty_bins(filled, ranges, "series", bins)


def length_histogram(df: DataFrame, measures: dict[str, tuple[str, int]], bins: int) -> DataFrame:
    """Histogram of integer measures, given as ``{series: (column, upper bound)}``."""
    columns = {name: F.when(is_number(F.col(c)), clip(F.col(c), upper)) for name, (c, upper) in measures.items()}
    return histogram_of_counts(value_counts(df, columns), bins)


def histogram(df: DataFrame, value: str, bins: int, by: str, levels: tuple) -> DataFrame:
    """Equal-width bins of a continuous column, one series per listed level of ``by``.

    Two scans, each combined before its tiny shuffle: the range first, then the bins.
    """
    listed = df.filter(F.col(by).isin(*levels))
    low, high = _widened(F.col("low"), F.col("high"))
    number = F.when(is_number(F.col(value)), F.col(value))
    ranges = (
        listed.groupBy(by)
        .agg(F.min(number).alias("low"), F.max(number).alias("high"))
        .select(by, low.alias("low"), high.alias("high"))
    )
    # At most one row per listed level.
    placed = listed.select(by, value).join(F.broadcast(ranges), by)
    filled = placed.groupBy(
        by, _bin_of(F.col(value), F.col("low"), F.col("high"), bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("cnt"))
    return _with_empty_bins(filled, ranges, by, bins)


def density(
    df: DataFrame, value: str, upper: int, by: str, points: int = DENSITY_POINTS
) -> DataFrame:
    """Gaussian kernel density of a clipped integer measure per class.

    Scott's bandwidth; the grid spans each class's range, extended by half of it on either
    side. The kernel sum runs over distinct values weighted by their counts, which is exact.
    A class without spread (one row, or one value only) has no density: its one row is that value as ``x``, with a null.
    """
    cut = clip(F.col(value), upper).cast("double").alias("value")
    counts = df.filter(is_number(F.col(value))).select(by, cut).groupBy(by, "value")
    return density_of_counts(counts.agg(F.count(F.lit(1)).alias("cnt")), by, points)


def density_of_counts(counts: DataFrame, by: str, points: int = DENSITY_POINTS) -> DataFrame:
    """From ``by, value, cnt``."""
    whole = Window.partitionBy(by)
    rows = F.sum("cnt").over(whole)
    mean = F.sum(F.col("value") * F.col("cnt")).over(whole) / rows
    stats = counts.withColumns(
        {
            "rows": rows,
            "mean": mean,
            "low": F.min("value").over(whole),
            "high": F.max("value").over(whole),
        }
    ).withColumn(
        "variance",
        F.try_divide(
            F.sum(F.col("cnt") * F.pow(F.col("value") - F.col("mean"), F.lit(2.0))).over(whole),
            F.col("rows") - 1,
        ),
    )
    flat = stats.filter(~F.coalesce(F.col("variance") > 0, F.lit(False))).select(
        by, F.lit(0).alias("point"), F.round("value", 6).alias("x"), F.lit(None).cast("double").alias("density")
    )
    stats = stats.filter(F.col("variance") > 0).withColumn(
        "width", F.pow(F.col("rows"), F.lit(-0.2)) * F.sqrt("variance")
    )
    spread = F.col("high") - F.col("low")
    gridded = stats.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).withColumn(
        "x", F.col("low") - 0.5 * spread + F.col("point") * (2.0 * spread / F.lit(points - 1.0))
    )
    distance = (F.col("x") - F.col("value")) / F.col("width")
    kernel = F.col("cnt") * F.exp(-0.5 * distance * distance)
    scale = F.col("rows") * F.col("width") * F.lit(math.sqrt(2.0 * math.pi))
    dense = gridded.groupBy(by, "point").agg(
        F.round(F.first("x"), 6).alias("x"),
        F.round(F.sum(kernel / scale), 9).alias("density"),
    )
    return dense.unionByName(flat)


def values_at(counts: DataFrame, ranks: DataFrame) -> DataFrame:
    """``series, rank, value``: the value at each rank (from 0) of each series of :func:`value_counts`.

    Two levels: totals of value ranges tell which range holds a rank, and only that range is ordered.
    """
    ranged = counts.withColumn("range", F.floor(F.col("value") / RANGE))
    up = Window.partitionBy("series").orderBy("range")
    totals = ranged.groupBy("series", "range").agg(F.sum("cnt").alias("n"))
    totals = totals.withColumn("upto", F.sum("n").over(up)).withColumn("before", F.col("upto") - F.col("n"))
    held = totals.join(ranks, "series").filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
    within = Window.partitionBy("series", "rank").orderBy("value")
    inside = ranged.join(held.select("series", "range", "rank", "before"), ["series", "range"])
    inside = inside.withColumn("upto", F.col("before") + F.sum("cnt").over(within))
    return inside.filter(F.col("rank") < F.col("upto")).groupBy("series", "rank").agg(F.min("value").alias("value"))


def summary(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of integer measures.

    Rounded to one decimal, halves to even; a quartile between two ranks is interpolated.
    """
    return summary_of_counts(value_counts(df, {name: F.col(c) for name, c in measures.items()}))


def summary_of_counts(counts: DataFrame) -> DataFrame:
    """From ``series, value, cnt``."""
    counts = counts.filter(F.col("value").isNotNull())
    plain = counts.groupBy("series").agg(
        F.sum("cnt").alias("count"), (F.sum(F.col("value") * F.col("cnt")) / F.sum("cnt")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    plain = materialize(plain)  # one row per measure
    away = F.col("cnt") * F.pow(F.col("value") - F.col("mean"), F.lit(2.0))
    spread = counts.join(F.broadcast(plain.select("series", "mean", "count")), "series").groupBy("series").agg(
        F.sqrt(F.try_divide(F.sum(away), F.first("count") - 1)).alias("std")
    )
    places = [F.struct(F.lit(q).alias("q"), ((F.col("count") - 1) * F.lit(q)).alias("place")) for q in QUARTILES]
    wanted = plain.select("series", F.inline(F.array(*places)))
    ranks = wanted.select("series", F.explode(F.array(F.floor("place"), F.ceil("place"))).alias("rank")).distinct()
    found = materialize(values_at(counts, ranks))
    low, high = (found.select("series", F.col("rank").alias(f"{s}_rank"), F.col("value").alias(s)) for s in ("low", "high"))
    quartiles = (
        wanted.withColumns({"low_rank": F.floor("place"), "high_rank": F.ceil("place")})
        .join(low, ["series", "low_rank"])
        .join(high, ["series", "high_rank"])
        .withColumn("value", F.col("low") + (F.col("place") - F.col("low_rank")) * (F.col("high") - F.col("low")))
        .groupBy("series")
        .agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"q{i}") for i, q in enumerate(QUARTILES)])
    )
    stats = plain.join(spread, "series").join(quartiles, "series")
    return stats.select(
        F.col("series").alias("measure"),
        "count",
        F.bround("mean", 1).alias("mean"),
        F.bround("std", 1).alias("std"),
        "min",
        F.bround("q0", 1).alias("p25"),
        F.bround("q1", 1).alias("p50"),
        F.bround("q2", 1).alias("p75"),
        "max",
    )
