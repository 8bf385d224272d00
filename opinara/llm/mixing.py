"""Mixing sources to target weights by Pfair scheduling.

A source's rows are dealt into blocks in a hashed order. With weight w, its k-th block (from 0) may
not run before slot floor(k / w) and must run by slot ceil((k + 1) / w). In every slot, among the
released blocks the one with the earliest deadline runs, so after any number t of slots each source
has run w * t blocks give or take less than one.

Weights are whole parts of a total P, so the schedule repeats after P slots and one period is all
that has to be laid out: a table of P rows, bounded by the parameters and not by the data. Block k
of a source with part a then has the slot (k / a) * P + period_slot[k mod a]. A source that runs out
leaves its slots empty; the others keep their order, and positions are counted without gaps. Until
the first source runs out, the bound holds in output blocks; from then on in slots.

Ranks within a source come from counts of hash slices, so that no source is gathered in one task.
Every row gets a place: nothing is dropped or repeated.

Defined results: null sources form a source of their own; a source without a given weight, or with a
weight that is null or not positive, gets the smallest part, 1; null keys and texts only enter the
hashed order; repeated rows get different positions; an empty table gives an empty mix. All input
columns, whatever their names, come back in the struct ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PARTS, BLOCK_ROWS, SLICE_ROWS, MAX_SOURCES = 1000, 16, 4096, 4096
ORDER_HEX = 15


def square_root_weights(docs: DataFrame, source: str = "source") -> DataFrame:
    """Target weights between natural and even: the square root of each source's rows."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sqrt(F.count(F.lit(1))).alias("weight"))


def source_parts(docs: DataFrame, weights: DataFrame, source: str, parts: int = PARTS) -> DataFrame:
    """``source, n_rows, part``: each source's whole part of the period, at least 1."""
    given = weights.filter(F.col("weight") > 0).groupBy("source").agg(F.max("weight").alias("weight"))
    given = given.withColumnRenamed("source", "wanted")
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = counts.join(given, F.col("source").eqNullSafe(F.col("wanted")), "left").drop("wanted")
    share = F.col("weight") / F.sum("weight").over(Window.partitionBy())
    part = F.greatest(F.round(share * parts), F.lit(1.0)).cast("long")
    return rows.select("source", "n_rows", F.coalesce(part, F.lit(1).cast("long")).alias("part"))


def period_schedule(parts: DataFrame) -> DataFrame:
    """One row: ``period``, the parts table as the array ``sources``, and ``runs``, the source index per slot."""
    ordered = parts.withColumn("index", F.row_number().over(Window.partitionBy().orderBy("source")) - 1)
    entry = F.struct("index", "source", "n_rows", "part")
    plan = ordered.agg(F.array_sort(F.collect_list(entry)).alias("sources"), F.sum("part").alias("period"))
    plan = plan.filter(F.size("sources") > 0)
    done = F.transform(F.col("sources"), lambda s: F.lit(0).cast("long"))
    start = F.struct(done.alias("done"), F.array().cast("array<int>").alias("runs"))
    slots = F.sequence(F.lit(0).cast("long"), F.col("period") - 1)
    return plan.select("period", "sources", F.aggregate(slots, start, _run_slot, lambda s: s["runs"]).alias("runs"))


def _run_slot(state: Column, slot: Column) -> Column:
    """Earliest deadline first among the blocks released by this slot; ties to the lower index."""
    period = F.col("period")

    def candidate(source, done):
        released = done * period < (slot + 1) * source["part"]
        deadline = F.call_function("div", (done + 1) * period + source["part"] - 1, source["part"])
        return F.when(released, F.struct(deadline.alias("deadline"), source["index"].alias("index")))

    pick = F.array_min(F.zip_with(F.col("sources"), state["done"], candidate))["index"]
    done = F.transform(state["done"], lambda n, i: n + (i == pick).cast("long"))
    return F.struct(done.alias("done"), F.concat(state["runs"], F.array(pick)).alias("runs"))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, key="doc_id", source="source",
    parts: int = PARTS, block_rows: int = BLOCK_ROWS, with_row: bool = False,
) -> DataFrame:
    """``doc_id, source, block, slot, position``: each row's block in its source, slot and place in the mix.

    ``weights`` has ``source, weight``; without it the weights are those of ``square_root_weights``.
    """
    weights = square_root_weights(docs, source) if weights is None else weights
    counted = source_parts(docs, weights, source, parts)
    # Bounded by MAX_SOURCES rows, checked here: everything below may be broadcast.
    totals = counted.agg(F.count(F.lit(1)), F.sum("n_rows")).first()
    if totals[0] > MAX_SOURCES:
        raise ValueError(f"{totals[0]} sources; merge them into {MAX_SOURCES} or fewer before mixing")
    plan = period_schedule(counted)
    own_slots = F.filter(F.sequence(F.lit(0).cast("long"), F.col("period") - 1), lambda t: F.col("runs")[t.cast("int")] == F.col("s.index"))
    sources = plan.select("period", "runs", F.explode("sources").alias("s")).select(
        F.col("s.source").alias("of"), F.col("s.part").alias("part"), "period", own_slots.alias("slots")
    )
    ranked = _ranked(docs, key, source, totals[1] or 0, with_row)
    rows = ranked.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("of")))
    block = F.floor(F.col("rank") / block_rows)
    turn = F.call_function("div", F.col("block"), F.col("part"))
    within = F.col("slots")[F.pmod("block", "part").cast("int")]
    rows = rows.withColumn("block", block).withColumns({"turn": turn, "within": within}).drop("slots", "part", "of")

    # Rows that ran in earlier periods, in closed form for each period that occurs.
    last = F.array_max(F.transform("sources", lambda s: F.floor(s["n_rows"] / (s["part"] * block_rows))))
    turns = plan.select("sources", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("turn"))
    ran = F.aggregate(
        F.col("sources"), F.lit(0).cast("long"),
        lambda sum_, s: sum_ + F.least(s["n_rows"], F.col("turn") * s["part"] * block_rows),
    )
    rows = rows.join(turns.select("turn", ran.alias("before")), "turn")
    in_period = Window.partitionBy("turn").orderBy("within", "rank")  # at most a period of blocks
    position = F.col("before") + F.row_number().over(in_period) - 1
    slot = F.col("turn") * F.col("period") + F.col("within")
    return rows.select("doc_id", "source", "block", slot.alias("slot"), position.alias("position"), *(["row"] if with_row else []))


def _ranked(docs: DataFrame, key: str, source: str, total: int, with_row: bool) -> DataFrame:
    """Each row's rank from 0 in its source's hashed order."""
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null"))), 1, ORDER_HEX), 16, 10)
    spread = max(1, total // SLICE_ROWS)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), bits.cast("long").alias("bits"),
        *([F.struct("*").alias("row")] if with_row else []),
    )
    width = -(-(1 << 4 * ORDER_HEX) // spread)
    rows = rows.withColumn("slice", F.call_function("div", F.col("bits"), F.lit(width)))
    counts = rows.groupBy("source", "slice").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("source").alias("of"), F.col("slice").alias("at"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier")
    )
    own = Window.partitionBy("source", "slice").orderBy("bits", "doc_id")
    rows = rows.withColumn("own", F.row_number().over(own) - 1)
    rows = rows.join(counts, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    return rows.withColumn("rank", F.col("earlier") + F.col("own")).drop("of", "at", "earlier", "own", "slice", "bits")


def in_mixed_order(docs: DataFrame, weights: DataFrame | None = None, key="doc_id", source="source") -> DataFrame:
    """The same rows and columns in the order of the mix, from the first partition to the last.

    Where the key names each row, only keys and sources pass through the schedule, and the rows meet
    their positions once; otherwise whole rows pass through it.
    """
    doubled = docs.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1))
    if doubled.isEmpty():
        places = mix(docs.select(key, source), weights, key, source)
        places = places.select(F.col("doc_id").alias("__key"), F.col("position").alias("__position"))
        placed = docs.join(places, F.col(key) == F.col("__key")).drop("__key")
        return placed.repartitionByRange("__position").sortWithinPartitions("__position").drop("__position")
    placed = mix(docs, weights, key, source, with_row=True).select("position", "row")
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
