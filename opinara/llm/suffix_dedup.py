"""Suffix-array dedup: cut every byte covered by a 200-byte string that starts anywhere else too.

Anchors bring equal strings together. Of the 96-byte grams in each 200-byte string the one of least
hash is its anchor; the choice looks at the string alone, so two equal strings have their anchors at
the same place. An anchor's context is what the 200-byte strings it is the anchor of cover. Three cases:

* an anchor that occurs once has no repeated string around it;
* a context that occurs twice as a whole is repeated as a whole, and is known by its hash;
* contexts that share their anchor only meet as bytes: one of each kind goes to the task of that
  anchor, which sorts all their suffixes in two stages and reads the repeated strings off the
  common prefixes of neighbours.

So copies never travel: thousands of equal contexts are counts, combined per task before the shuffle.
An anchor with more than ``WIDE`` different contexts would be too much for a task; its strings are
counted by their hashes (128 bits) instead, which deals them out evenly. Cuts are judged on the input,
positions are bytes of the UTF-8 text.

Defined results: null texts are empty; texts below 200 bytes lose nothing; repeated rows, and rows that
share a key, are documents of their own, so copies are cut whole; null keys are kept. An empty table
gives an empty result. Other columns play no part. Kept bytes may break a character in two, so they
are bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opinara.llm import kernels, suffixes
from opinara.llm.frames import documents_of, map_batches, materialize, small_batches, store

LENGTH, GRAM, WIDE = 200, 96, 4096
POOL_BYTES, PIECE_ROWS = 1 << 18, 256
CUT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<long>"
REST_SCHEMA = "anchor long, context long, doc long, pos int, low int, bytes binary"
FOUND_SCHEMA = "anchor long, context long, low int, high int"


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: what is made of a row can be much larger than the row."""
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(start, PIECE_ROWS)


def sliding(values: np.ndarray, width: int, take: np.ufunc, pad: int) -> np.ndarray:
    """``take`` (minimum or maximum) over each window of ``width`` values."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    padded = np.full(rows * width, pad, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    ahead = take.accumulate(blocks, axis=1).reshape(-1)
    behind = take.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return take(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors_of(slab: kernels.Slab, length: int, gram: int):
    """Row, place, gram hash, context hash and context bounds of every anchor, as places in the slab."""
    data, offsets = slab.data, slab.offsets
    if len(data) < length:
        return None
    sums = kernels.prefix_hash(data, kernels.letters(11))
    at = np.arange(len(data) - gram + 1)
    hashes = kernels.span_hash(sums, at, at + gram)
    hashes |= np.uint64(1)  # 0 marks strings that leave their document
    width = length - gram + 1
    least = sliding(hashes, width, np.minimum, 0xFFFFFFFFFFFFFFFF)
    inside = np.zeros(len(least), bool)
    for start, stop in zip(offsets[:-1], offsets[1:]):
        inside[start : max(stop - length + 1, start)] = True
    least[~inside] = 0
    # A gram is an anchor if it is the least of any string around it.
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    places = np.flatnonzero(sliding(around, width, np.maximum, 0) == hashes)
    if not len(places):
        return None
    # Its strings begin in one run of ``least``: the last run at or before it that holds its hash.
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(starts[1:], len(least)) - 1
    run = np.searchsorted(starts, places, "right") - 1
    while (other := least[starts[run]] != hashes[places]).any():
        run -= other
    low = np.maximum(starts[run], places - width + 1)
    high = np.minimum(ends[run], places) + length
    shape = (places - low).astype(np.uint64) * kernels.SECOND
    context = kernels.mix(kernels.span_hash(sums, low, high) + shape)
    row = np.searchsorted(offsets, places, "right") - 1
    return row, places, hashes[places], context, low - places, high - places


def anchor_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``anchor, context, doc, pos, low, high``; the context's bounds are relative to the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            # An anchor's strings lie within a length of it, and their anchors within another.
            parts = (part for slab in kernels.slabs(batch.column(1)) for part in kernels.windows(slab, 2 * length))
            for slab, begin, first, last in parts:
                found = anchors_of(slab, length, gram)
                if found is None:
                    continue
                own = (found[1] >= first) & (found[1] < last)
                row, places, anchor, context, low, high = (column[own] for column in found)
                pos = (places - slab.offsets[row] + begin).astype(np.int32)
                columns = [kernels.signed(anchor), kernels.signed(context), keys[slab.first + row], pos, low.astype(np.int32), high.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "context", "doc", "pos", "low", "high"])

    return map_batches(docs, run, "anchor long, context long, doc long, pos int, low int, high int")


def context_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the contexts listed in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            docs_, texts, listed = (batch.column(i) for i in range(3))
            offsets, data = kernels.bytes_of(texts)
            bounds = listed.offsets.to_numpy()
            within = listed.values.slice(bounds[0], bounds[-1] - bounds[0])
            anchor, context, pos, low, high = (c.to_numpy() for c in within.flatten())
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            doc, start = docs_.to_numpy()[row], offsets[row] + pos + low
            ends = np.concatenate([[0], np.cumsum(high - low, dtype=np.int64)])
            done = 0
            while done < len(row):
                stop = max(int(np.searchsorted(ends, ends[done] + kernels.SLAB_BYTES, "right")) - 1, done + 1)
                sizes = (ends[done : stop + 1] - ends[done]).astype(np.int32)
                at = np.repeat(start[done:stop] - sizes[:-1], np.diff(sizes)) + np.arange(sizes[-1])
                raw = pa.Array.from_buffers(pa.binary(), stop - done, [None, pa.py_buffer(sizes), pa.py_buffer(data[at])])
                columns = [*(pa.array(c[done:stop]) for c in (anchor, context, doc, pos, low)), raw]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "context", "doc", "pos", "low", "bytes"])
                done = stop

    listed = F.collect_list(F.struct("anchor", "context", "pos", "low", "high"))
    places = wanted.groupBy(F.col("doc").alias("of")).agg(listed.alias("places"))
    joined = docs.join(places, F.col("doc") == F.col("of")).select("doc", "text", "places")
    return map_batches(joined, run, REST_SCHEMA)


class Pool:
    """Contexts of whole anchors, as columns of one Arrow table."""

    def __init__(self, table: pa.Table, length: int):
        self.names = [table.column(c).to_numpy() for c in ("anchor", "context")]
        self.low = table.column("low").to_numpy().astype(np.int64)
        raw = table.column("bytes").to_pylist()
        self.starts = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        self.text = np.frombuffer(b"".join(raw), np.uint8)
        _, doc = np.unique(table.column("doc").to_numpy(), return_inverse=True)
        # Where the context begins in the corpus.
        self.origin = (doc.astype(np.int64) << 40) + table.column("pos").to_numpy() + self.low
        self.length = length

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in the pool where a string lies whole within its context, and which context."""
        counts = np.maximum(np.diff(self.starts) - self.length + 1, 0)
        owner = np.repeat(np.arange(len(counts)), counts)
        return self.starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts), owner

    def repeated(self) -> np.ndarray:
        """Places in the pool where a string begins that begins elsewhere in the corpus as well."""
        places, owners = self.strings()
        owner = np.full(len(self.text), -1)
        owner[places] = owners
        order = suffixes.suffix_array(self.text, self.length)
        order = order[owner[order] >= 0]
        if not len(order):
            return order
        heads = np.flatnonzero(suffixes.common_prefixes(self.text, order, self.length) < self.length)
        # One place of the corpus can lie in several contexts; it does not repeat itself.
        origin = self.origin[owner[order]] + order - self.starts[owner[order]]
        several = np.minimum.reduceat(origin, heads) != np.maximum.reduceat(origin, heads)
        return np.sort(order[np.repeat(several, np.diff(np.append(heads, len(order))))])

    def spans(self) -> pa.RecordBatch:
        places = self.repeated()
        owner = np.searchsorted(self.starts, places, "right") - 1
        first = np.ones(len(places), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (places[1:] > places[:-1] + self.length)
        last = np.ones(len(places), bool)
        last[:-1] = first[1:]
        at = self.starts[owner] - self.low[owner]
        low, high = (places - at)[first], (places + self.length - at)[last]
        names = [pa.array(column[owner[first]]) for column in self.names]
        arrays = [*names, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "context", "low", "high"])


def sorted_contexts(rest: DataFrame, length: int) -> DataFrame:
    """``anchor, context, low, high``: repeated spans relative to the anchor, by suffix arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            anchors = table.column("anchor").to_numpy()
            places = np.cumsum([len(b) for b in table.column("bytes").to_pylist()])
            ends = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1  # where one anchor's rows end
            done = 0
            if held and held[-1].column("anchor")[-1].as_py() != anchors[0]:
                ends = np.concatenate([[0], ends])
            for end in ends:
                taken = size + (places[end - 1] if end else 0) - (places[done - 1] if done else 0)
                if taken >= POOL_BYTES:
                    held.append(table.slice(done, end - done))
                    yield Pool(pa.concat_tables(held), length).spans()
                    held, size, done = [], 0, end
            held.append(table.slice(done))
            size += int(places[-1] - (places[done - 1] if done else 0))
        if held:
            yield Pool(pa.concat_tables(held), length).spans()

    dealt = rest.repartition("anchor").sortWithinPartitions("anchor")
    return map_batches(dealt, run, FOUND_SCHEMA)


def counted_strings(rest: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: every string by its hash, in counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                table = pa.Table.from_batches([batch.slice(start, 1024)])
                pool = Pool(table, length)
                places, owner = pool.strings()
                hashes = (kernels.span_hash(kernels.prefix_hash(pool.text, kernels.letters(s)), places, places + length) for s in (12, 13))
                low = places - pool.starts[owner] + pool.low[owner]
                columns = [
                    *map(kernels.signed, hashes), *(name[owner] for name in pool.names), table.column("doc").to_numpy()[owner],
                    low.astype(np.int32), table.column("pos").to_numpy()[owner] + low,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["one", "two", "anchor", "context", "doc", "low", "start"])

    strings = map_batches(rest, run, "one long, two long, anchor long, context long, doc long, low int, start long")
    where = F.struct("doc", "start")
    ends = strings.groupBy("one", "two").agg(F.min(where).alias("least"), F.max(where).alias("most"))
    repeated = ends.filter("least <> most").select("one", "two")
    found = strings.join(repeated, ["one", "two"])
    return found.select("anchor", "context", "low", (F.col("low") + length).cast("int").alias("high")).distinct()


def _unique_keys(rows: DataFrame) -> DataFrame:
    """``doc, text``: doc is the key where that names each row, else a number given here, with ``doc_id``."""
    doubled = rows.groupBy("doc_id").count().filter("doc_id is null or count > 1")
    if doubled.isEmpty():
        # The filter drops nothing; with it, both joins below read one and the same exchange.
        return rows.select(F.col("doc_id").alias("doc"), "text").filter("doc is not null")
    return store(rows.withColumn("doc", F.monotonically_increasing_id()), "numbered")


def by_context(found: DataFrame) -> DataFrame:
    """``anchor, context, edges``: one row per context, its spans merged, starts and ends alternating.

    A context is at most two strings and an anchor long, so its spans are few.
    """

    def join(edges: Column, span: Column) -> Column:
        grown = F.concat(
            F.slice(edges, F.lit(1), F.greatest(F.size(edges) - 1, F.lit(0))),
            F.array(F.greatest(F.try_element_at(edges, F.lit(-1)), span["high"])),
        )
        return F.when((F.size(edges) > 0) & (F.try_element_at(edges, F.lit(-1)) >= span["low"]), grown).otherwise(
            F.concat(edges, F.array(span["low"], span["high"]))
        )

    spans = found.groupBy("anchor", "context").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("spans"))
    return spans.select("anchor", "context", F.aggregate("spans", F.array().cast("array<int>"), join).alias("edges"))


def spans_of_places(places: DataFrame, found: DataFrame) -> DataFrame:
    """``of, spans``: the repeated spans of each document.

    A place meets the one row of its context; a context of many strings would else meet each of its places with each string.
    """
    # Written out, so that the join deals both sides anew and Spark can split a hot context.
    merged_ = store(by_context(found), "spans")
    met = places.select("doc", "pos", "anchor", "context").join(merged_, ["anchor", "context"])
    numbers = F.sequence(F.lit(0), F.size("edges") - 1, F.lit(2))
    moved = F.transform(
        numbers,
        lambda i: F.struct((F.col("pos") + F.get("edges", i)).alias("low"), (F.col("pos") + F.get("edges", i + 1)).alias("high")),
    )
    listed = met.groupBy(F.col("doc").alias("of")).agg(F.collect_list(moved).alias("spans"))
    return listed.select("of", F.flatten("spans").alias("spans"))


def cut_repeated_bytes(docs: DataFrame, key="doc_id", text="text", length: int = LENGTH, gram: int = GRAM, wide: int = WIDE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, spans`` (starts and ends of the cuts, alternating)."""
    small_batches(docs.sparkSession)
    rows = _unique_keys(documents_of(docs, key, text))
    texts = rows.select("doc", "text")
    anchors = anchor_table(texts, length, gram)
    # Written out, so that the join deals both sides anew and Spark can split a hot anchor.
    often = materialize(anchors.groupBy("anchor").count().filter("count > 1").select("anchor"))
    places = store(anchors.join(often, "anchor"), "anchors")

    one = F.min(F.struct("doc", "pos", "low", "high")).alias("one")
    contexts = store(places.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), one), "contexts")
    whole = contexts.filter("n > 1").select("anchor", "context", "one.low", "one.high")
    kinds = materialize(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"))
    rest = contexts.join(kinds.filter(F.col("kinds") <= wide), "anchor", "left_semi").select("anchor", "context", "one.*")
    many = kinds.filter(F.col("kinds") > wide)
    known = ["anchor", "context"]
    found = whole.unionByName(sorted_contexts(context_bytes(texts, rest), length))
    if not many.isEmpty():
        broad = contexts.join(many, "anchor", "left_semi").select("anchor", "context", "one.*")
        found = found.unionByName(counted_strings(context_bytes(texts, broad), length))
    spans = spans_of_places(places, found)
    name = F.col("doc_id" if "doc_id" in rows.columns else "doc").alias("doc_id")
    joined = rows.join(spans, F.col("doc") == F.col("of"), "left").select(name, "text", "spans")
    return map_batches(joined, _cut, CUT_SCHEMA)


def merged(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Edges of the union of spans, starts and ends alternating; spans that touch are one."""
    turn = np.argsort(low, kind="stable")
    low, high = low[turn], np.maximum.accumulate(high[turn]) if len(turn) else high
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    return np.column_stack([low[new], high[np.append(new[1:], True)] if len(low) else high]).ravel()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        removed, counts, kept, spans = [], [], [], []
        offsets, data = kernels.bytes_of(batch.column(1))
        sizes = np.diff(offsets)
        for row, found in enumerate(batch.column(2)):
            raw = data[offsets[row] : offsets[row + 1]]
            cuts = np.zeros(0, np.int64)
            if found.is_valid:
                low, high = (c.to_numpy().astype(np.int64) for c in found.values.flatten())
                cuts = merged(np.maximum(low, 0), np.minimum(high, len(raw)))
            edges = np.concatenate([[0], cuts, [len(raw)]])
            removed.append(int((cuts[1::2] - cuts[::2]).sum()))
            counts.append(len(cuts) // 2)
            kept.append(b"".join(raw[edges[i] : edges[i + 1]].tobytes() for i in range(0, len(edges), 2)))
            spans.append(cuts)
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, counts)), pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])
