"""Sharding by extendible hashing: shards no larger than a byte limit, whatever the skew of sizes.

Every row has 60 hash bits. The directory starts as one bucket, and only a bucket over the limit
splits on its next bit. A bucket is a prefix of the bits, so a row's shard is the shortest prefix
of its bits whose rows fit the limit. Sizes of prefixes come from partial sums; each round looks
a bounded number of bits ahead, and later rounds only read rows of buckets still too large.

Rows that agree in all bits (copies under one key, null keys) can't be parted by more bits. They
overflow into pages: rows over half the limit get a page each, the others fill pages half a limit
at a time by running sums within the slices they were read in, so no bucket is gathered in one
task. A page only exceeds the limit if one row alone does.

Defined results: null texts have 0 bytes; a null key hashes as the text ``null``; repeated rows share
a bucket or its pages, each in its own place; an empty table has no shards. ``with_row`` returns all
input columns, whatever their names, in the struct ``row``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.llm.frames import materialize, text_of

BITS, AHEAD = 60, 4
BYTE_LIMIT = 1 << 20


def hash_bits(key: str) -> Column:
    """The first 60 bits of the key's MD5 as a long."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")


def prefix(bits: Column, length: int, depth: Column) -> Column:
    """The first ``depth`` bits of a prefix of ``length`` bits."""
    return F.call_function("shiftright", bits, (F.lit(length) - depth).cast("int"))


def cell_depths(rows: DataFrame, open_: DataFrame | None, start: int, stop: int, limit: int) -> DataFrame:
    """For each prefix of ``stop`` bits below an open bucket: depth of the bucket that fits, or null.

    ``open_`` holds the prefixes of ``start`` bits that are over the limit; none means the root.
    """
    cells = rows.groupBy(prefix(F.col("bits"), BITS, F.lit(stop)).alias("cell")).agg(F.sum("bytes").alias("bytes"))
    if open_ is not None:
        cells = cells.join(open_, prefix(F.col("cell"), stop, F.lit(start)) == F.col("open"), "left_semi")
    levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(start + 1), F.lit(stop))).alias("depth"))
    levels = levels.withColumn("prefix", prefix(F.col("cell"), stop, F.col("depth")))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total")).filter(F.col("total") <= limit)
    found = levels.join(fits, ["depth", "prefix"], "left")
    return found.groupBy("cell").agg(F.min(F.when(F.col("total").isNotNull(), F.col("depth"))).alias("fit"))


def assign_shards(docs: DataFrame, key="doc_id", text="text", limit: int = BYTE_LIMIT, with_row: bool = False) -> DataFrame:
    """``doc_id, bytes, depth, shard, page``: shard is the bucket's prefix as a text of 0 and 1."""
    size = F.octet_length(text_of(text)).cast("long")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), hash_bits(key).alias("bits"), size.alias("bytes"),
        *([F.struct("*").alias("row")] if with_row else []),
    )
    sizes = rows.select("bits", "bytes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    if total <= limit:
        return _named(rows.withColumn("depth", F.lit(0)).withColumn("page", F.lit(0).cast("long")), with_row)
    start, stop = 0, min(BITS, math.ceil(math.log2(total / limit)) + AHEAD)
    rows, open_ = rows.withColumn("depth", F.lit(None).cast("int")), None
    while True:
        depths = materialize(cell_depths(sizes, open_, start, stop, limit))
        cell = prefix(F.col("bits"), BITS, F.lit(stop))
        rows = rows.join(depths, cell == F.col("cell"), "left")
        rows = rows.withColumn("depth", F.coalesce("depth", "fit")).drop("cell", "fit")
        open_ = depths.filter(F.col("fit").isNull()).select(F.col("cell").alias("open"))
        if open_.isEmpty():
            return _named(rows.withColumn("page", F.lit(0).cast("long")), with_row)
        if stop == BITS:
            return _named(_paged(rows, limit), with_row)
        sizes = sizes.join(open_, prefix(F.col("bits"), BITS, F.lit(stop)) == F.col("open"), "left_semi")
        start, stop = stop, min(BITS, stop + 2 * AHEAD)


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Pages for the rows of buckets that all 60 bits could not bring below the limit."""
    fitting = rows.filter(F.col("depth").isNotNull()).withColumn("page", F.lit(0).cast("long"))
    large = F.col("bytes") * 2 > limit
    place = rows.filter(F.col("depth").isNull()).withColumns({
        "depth": F.lit(BITS), "slice": F.spark_partition_id(), "single": large.cast("int"),
        # What a row takes up: one place among the large rows, its bytes among the others.
        "fill": F.when(large, F.lit(1)).otherwise(F.col("bytes")).cast("long"),
    })
    place = materialize(place)  # slices must not be dealt anew between the two uses
    sums = place.groupBy("bits", "single", "slice").agg(F.sum("fill").alias("sum"))
    before = Window.partitionBy("bits", "single").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
    within = Window.partitionBy("bits", "single", "slice").orderBy("bytes", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("fill").over(within), F.lit(0)) + F.col("before")
    placed = place.join(sums, ["bits", "single", "slice"]).withColumn("at", at)
    # Odd pages hold single large rows, even ones the rest.
    half = max(limit // 2, 1)
    page = F.when(F.col("single") == 1, F.col("at") * 2 + 1).otherwise(F.floor(F.col("at") / half) * 2)
    placed = placed.withColumn("page", page.cast("long"))
    return fitting.unionByName(placed.select(*fitting.columns))


def _named(rows: DataFrame, with_row: bool) -> DataFrame:
    value = F.call_function("shiftright", F.col("bits"), (F.lit(BITS) - F.col("depth")).cast("int"))
    # A shift by 60 bits leaves 0, whose text is dropped at depth 0.
    shard = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin(value), F.lit(BITS), "0"))
    shard = F.substring(shard, F.lit(BITS + 1) - F.col("depth"), F.col("depth"))
    return rows.select("doc_id", "bytes", "depth", shard.alias("shard"), "page", *(["row"] if with_row else []))
