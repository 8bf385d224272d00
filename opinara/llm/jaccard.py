"""N-gram Jaccard join by PartEnum signatures: exact components of near-duplicate documents.

A document is the set of its word 4-grams (hashes of 64 bits). Two sets link when their Jaccard
similarity is at least 85 %. Sets of one size band whose similarity suffices differ in at most k
elements, a bound that follows from the band's largest size. So the domain of grams is dealt into
k + 1 + e parts by a hash: linked sets then agree on at least 1 + e whole parts, and one signature
per part (a hash of the part's grams) brings every linked pair together. Parts holding fewer than two
grams of a set are thin: they match by chance and get no signature, which loses nothing for a set
with at most e thin parts, because an agreed part is thin on both sides. A set with more thin parts
signs those too, so two such sets still meet there. Sets sign in their own band and the next, since
a partner may lie one band higher. Sets of ``LARGE`` elements or more get as many parts again, all of which
are signed unless empty: linked ones then agree on many, and each leaves out its most common
signatures but for one of so many, so that passages which many texts hold bring no unlike texts together.

Equal sets are one node from the start. Pairs that share a signature are not listed at first: every node
is held against one hub it shares a signature with, links contract into components, and only nodes
that share a signature across components are left. Their pairs are all
held against a bound on bits, and those it lets through are tested. Every link taken is verified on
the whole sets, which are made and written for the nodes of such pairs only; all others are known by
their bits. A pair skipped is one whose documents are connected already.

Defined results: null or empty texts and texts without words have 0 shingles and are alone; repeated
rows, and different rows under one key, come back one row each; a null key is a document like any
other, its component is the smallest key that is not null, if any. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.llm import kernels
from opinara.llm.components import components
from opinara.llm.frames import documents_of, map_batches, materialize, small_batches, store

SHINGLE_WORDS, PERCENT, THIN = 4, 85, 2
LARGE = 1024  # shingles: from here on more and smaller parts, so that the most common signatures can go
LONG_WORD = 64  # bytes
GRAM_STEP = 1 << 18  # shingles of a text hashed at a time
SEEN_NODES = 1 << 19  # nodes a task remembers so as not to sign a copy twice
# A set's parity bits: for each of 64 * PARITY values of its grams' hashes, whether their number is odd.
PARITY, WIDE = 16, 64
PARITIES = [f"p{i}" for i in range(PARITY)]
BITS_SCHEMA = ", ".join(f"{p} long" for p in PARITIES) + ", wide array<long>"
SETS_SCHEMA = f"doc_id long, n_shingles long, node long, other long, even int, odd int, {BITS_SCHEMA}"
SIGNED_SCHEMA = "signature long, node long"


def fold_case(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_hashes(slab: kernels.Slab, found: kernels.Words, seed: int) -> np.ndarray:
    """Hashes of 64 bits. Long words are digested: there are long strings on which a polynomial
    modulo 2^64 agrees whatever its letters' values."""
    hashes = kernels.span_hash(kernels.prefix_hash(slab.data, kernels.letters(seed)), found.starts, found.ends)
    salt = seed.to_bytes(8, "little")
    for i in np.flatnonzero(found.ends - found.starts > LONG_WORD):
        digest = blake2b(slab.data[found.starts[i] : found.ends[i]].tobytes(), digest_size=8, salt=salt)
        hashes[i] = int.from_bytes(digest.digest(), "little")
    return hashes


def shingle_sets(slab: kernels.Slab, size: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each text of a slab that has words."""
    parts = list(_word_rows(slab, seed))
    doc, hashes = (np.concatenate(column) for column in zip(*parts))
    edges = np.searchsorted(doc, np.arange(len(slab) + 1))
    for row in range(len(slab)):
        start, stop = edges[row], edges[row + 1]
        if stop - start >= size:
            # A long text's windows one after another: only the distinct ones are kept.
            steps = range(start, stop - size + 1, GRAM_STEP)
            sets = [np.unique(kernels.grams(hashes[at : min(at + GRAM_STEP + size - 1, stop)], size)) for at in steps]
            yield row, sets[0] if len(sets) == 1 else np.unique(np.concatenate(sets))
        elif stop > start:
            # Marked by its length, so as never to equal the gram of a longer text.
            whole = kernels.grams(hashes[start:stop], int(stop - start))
            yield row, kernels.mix(whole + np.uint64(stop - start))


def _word_rows(slab: kernels.Slab, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of each word; a long text is worked through in parts."""
    for part in kernels.blank_cuts(slab):
        folded = kernels.Slab(part.first, fold_case(part.data), part.offsets)
        found = kernels.words(folded)
        yield found.doc, word_hashes(folded, found, seed)


def node_of(grams: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit names of a set."""
    count = np.uint64(len(grams))
    first = kernels.mix(np.array([kernels.mix(grams).sum() + count], np.uint64))
    other = kernels.mix(np.array([kernels.mix(grams ^ kernels.SECOND).sum() ^ count], np.uint64))
    return int(kernels.signed(first)[0]), int(kernels.signed(other)[0])


def bands(percent: int = PERCENT, most: int = 1 << 40) -> np.ndarray:
    """Largest size of each band; a partner of a set lies in its band or a neighbouring one."""
    ends = [1]
    while ends[-1] < most:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
    return np.array(ends)


def difference(largest: int, percent: int = PERCENT) -> int:
    """Elements by which two similar sets of at most ``largest`` elements can differ."""
    return 2 * largest * (100 - percent) // (100 + percent)


def parted(grams: np.ndarray, tag: int, largest: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Salted grams, the part of each, which parts are thin, and how many of these are allowed for."""
    k = difference(largest, percent)
    spare, least = (3 + k, 1) if largest >= LARGE else (3 + k // 7, THIN)
    salted = kernels.mix(grams + kernels.mix(np.array([tag], np.uint64)))
    part = (salted % np.uint64(k + 1 + spare)).astype(np.int64)
    return salted, part, np.bincount(part, minlength=k + 1 + spare) < least, spare


def signatures(grams: np.ndarray, ends: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The set's signatures in its own band and the next; the last bit is that of the band's number."""
    band = int(np.searchsorted(ends, len(grams)))
    out = []
    for tag in (band, band + 1):
        if difference(int(ends[tag]), percent) == 0:
            continue  # only equal sets are similar, and those are one node
        salted, part, thin, spare = parted(grams, tag, int(ends[tag]), percent)
        sums = np.zeros(len(thin), np.uint64)
        np.add.at(sums, part, kernels.mix(salted))
        label = np.arange(len(thin), dtype=np.uint64) + np.uint64(tag) * np.uint64(1 << 40)
        marks = kernels.mix(sums + kernels.mix(label)) & ~np.uint64(1) | np.uint64(tag & 1)
        out.append(marks if thin.sum() > spare else marks[~thin])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def dispensable(grams: np.ndarray, ends: np.ndarray, percent: int = PERCENT) -> tuple[int, int]:
    """How many of its most common signatures the set can do without, in the band of even and of odd number.

    Linked sets agree on ``1 + e`` parts or more. In a set with fewer than ``e`` thin parts, the others of these
    are signed on both sides.
    """
    band = int(np.searchsorted(ends, len(grams)))
    out = [0, 0]
    for tag in (band, band + 1):
        *_, thin, spare = parted(grams, tag, int(ends[tag]), percent)
        out[tag & 1] = max(spare - int(thin.sum()), 0)
    return out[0], out[1]


def documents_sets(docs: DataFrame, size: int, percent: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = bands(percent)
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            names = np.zeros((2, batch.num_rows), np.int64)
            free = np.zeros((2, batch.num_rows), np.int32)
            few, wide = (np.zeros((batch.num_rows, longs), np.int64) for longs in (PARITY, WIDE))
            for slab in kernels.slabs(batch.column(1)):
                for row, grams in shingle_sets(slab, size, seed):
                    counts[slab.first + row] = len(grams)
                    names[:, slab.first + row] = node_of(grams)
                    free[:, slab.first + row] = dispensable(grams, ends, percent)
                    few[slab.first + row], wide[slab.first + row] = parity(grams, PARITY), parity(grams, WIDE)
            columns = [batch.column(0), *map(pa.array, (counts, *names, *free, *few.T)), lists(wide)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node", "other", "even", "odd", *PARITIES, "wide"])

    return map_batches(docs, run, SETS_SCHEMA)


def signed_nodes(docs: DataFrame, size: int, percent: int, seed: int) -> DataFrame:
    """``signature, node``, a node once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        ends = bands(percent)
        for batch in batches:
            for slab in kernels.slabs(batch.column(0)):
                marks, nodes = [], []
                for _, grams in shingle_sets(slab, size, seed):
                    node, _ = node_of(grams)
                    if node in seen:
                        continue
                    if len(seen) < SEEN_NODES:
                        seen.add(node)
                    own = signatures(grams, ends, percent)
                    marks.append(own)
                    nodes.append(np.full(len(own), node, np.int64))
                if marks:
                    columns = [pa.array(kernels.signed(np.concatenate(marks))), pa.array(np.concatenate(nodes))]
                    yield pa.RecordBatch.from_arrays(columns, ["signature", "node"])

    return map_batches(docs.select("text"), run, SIGNED_SCHEMA)


def shared_signatures(signed: DataFrame) -> DataFrame:
    """``signature, node, hub`` where two or more nodes share the signature; hub is the smallest.

    Partitions are sorted and streamed: what is carried on from batch to batch is one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = hub = last = None  # of the group that the last batch ended in
        told = False  # whether the hub's own row is out
        for batch in batches:
            marks, nodes = (batch.column(i).to_numpy() for i in range(2))
            if not len(marks):
                continue
            new = np.ones(len(marks), bool)
            new[1:] = marks[1:] != marks[:-1]
            again = np.zeros(len(marks), bool)
            again[1:] = ~new[1:] & (nodes[1:] == nodes[:-1])
            if mark is not None and marks[0] == mark:
                new[0], again[0] = False, nodes[0] == last
            group = np.cumsum(new) - 1  # -1: the group carried on
            heads = nodes[new]
            hubs = np.where(group >= 0, heads[np.maximum(group, 0)] if len(heads) else 0, hub if hub is not None else 0)
            keep = ~again & (nodes != hubs)
            out_marks, out_nodes, out_hubs = [marks[keep]], [nodes[keep]], [hubs[keep]]
            firsts, at = np.unique(group[keep], return_index=True)
            wanted = (firsts >= 0) | (not told)
            for column, value in ((out_marks, marks), (out_nodes, hubs), (out_hubs, hubs)):
                column.append(value[keep][at][wanted])
            mark, last, hub = marks[-1], nodes[-1], hubs[-1]
            told = bool(len(firsts) and firsts[-1] == group[-1]) or (told and group[-1] < 0)
            columns = [pa.array(np.concatenate(c)) for c in (out_marks, out_nodes, out_hubs)]
            yield pa.RecordBatch.from_arrays(columns, ["signature", "node", "hub"])

    dealt = signed.repartition("signature").sortWithinPartitions("signature", "node")
    return map_batches(dealt, run, "signature long, node long, hub long")


def parity(grams: np.ndarray, longs: int) -> np.ndarray:
    """As many longs as asked for; each gram that two sets do not share turns one bit at most."""
    odd = np.bincount((grams % np.uint64(64 * longs)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def gram_sets(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """``node, n, grams`` of the documents given, and their wide parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in kernels.slabs(batch.column(0)):
                found = [(node_of(g)[0], kernels.signed(g), parity(g, WIDE)) for _, g in shingle_sets(slab, size, seed)]
                columns = [
                    pa.array([n for n, _, _ in found], pa.int64()), pa.array([len(g) for _, g, _ in found], pa.int64()),
                    pa.array([g for _, g, _ in found], pa.list_(pa.int64())), pa.array([w for *_, w in found], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "grams", "wide"])

    return map_batches(docs.select("text"), run, "node long, n long, grams array<long>, wide array<long>")


def sets_of(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, unique: bool, size: int, seed: int) -> DataFrame:
    """The whole sets of the nodes in ``a, b``, from the text of one document each."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    owners = wanted.join(nodes, "node").select(F.col("first").alias("owner"))
    texts = rows.join(owners, F.col("doc_id").eqNullSafe(F.col("owner")), "left_semi")
    # Equal sets have one owner each; only rows that share a key with one can be there besides.
    sets = gram_sets(texts, size, seed)
    return store(sets if unique else sets.dropDuplicates(["node"]), "grams")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""
    sets = sets.select("node", "grams")
    sides = pairs.join(sets.withColumnsRenamed({"node": "a", "grams": "left"}), "a")
    sides = sides.join(sets.withColumnsRenamed({"node": "b", "grams": "right"}), "b")
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - F.col("common")
    return sides.withColumn("common", common).filter(F.col("common") * 100 >= union * percent).select("a", "b")


def join_components(
    docs: DataFrame, key="doc_id", text="text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document."""
    small_batches(docs.sparkSession)
    rows, seed = documents_of(docs, key, text), 0
    while True:
        named = store(documents_sets(rows, size, percent, seed), "sets")
        nodes = named.filter("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("first"), F.min("other").alias("low"), F.max("other").alias("high")
        )
        nodes = store(nodes, "nodes")
        if nodes.filter("low <> high").isEmpty():
            break
        seed += 1  # two different sets met under one 64-bit name
    shared = store(shared_signatures(signed_nodes(rows, size, percent, seed)), "signatures")
    shared = store(_rare(shared, named.filter("n_shingles > 0").select("node", "even", "odd").distinct()), "rare")
    unique = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    bits = named.filter("n_shingles > 0").select("node", F.col("n_shingles").alias("n"), *PARITIES, "wide").dropDuplicates(["node"])
    bits = store(bits.join(shared.select("node").distinct(), "node", "left_semi"), "bits")

    # Everyone against the hub that shares the most signatures with others: the original of a group
    # of edited copies holds nearly all their signatures, each copy only some.
    weights = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    placed = shared.select("signature", "node").join(weights, "node")
    hubs = placed.groupBy("signature").agg(F.max(F.struct("weight", "node")).alias("hub"))
    offers = placed.join(store(hubs, "hubs"), "signature").filter(F.col("node") != F.col("hub.node"))
    chosen = offers.groupBy("node").agg(F.max("hub").alias("hub"))
    tested = store(_pairs(F.col("node"), F.col("hub.node"), chosen), "tested")
    near = store(_close(tested, bits, percent), "near")
    links = store(verified(near, sets_of(near, nodes, rows, unique, size, seed), percent), "links")

    # What is left: nodes that share a signature across components.
    left = _across(shared, materialize(components(links)))
    pairs = _all_pairs(left, bits, percent)
    near = store(_close(pairs.join(tested, ["a", "b"], "left_anti"), bits, percent), "near")
    links = links.union(verified(near, sets_of(near, nodes, rows, unique, size, seed), percent))
    found = materialize(components(links))

    smallest = found.join(nodes, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    ids = found.join(smallest, "component").select("node", "component_id")
    ids = nodes.join(ids, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id"))
    ids = ids.withColumnRenamed("node", "of")
    same = (F.col("node") == F.col("of")) & (F.col("n_shingles") > 0)
    return named.join(ids, same, "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _rare(shared: DataFrame, free: DataFrame) -> DataFrame:
    """``signature, node, n`` without the most common signatures that nodes can do without; n: nodes that share it.

    Linked nodes share at least one signature more than either can do without. Of those they share, all
    but the rarest are more common than it, so neither leaves that one out. Ties go by signature, the same for all nodes.
    """
    sizes = store(shared.groupBy("signature").agg(F.count(F.lit(1)).alias("n")), "sizes")
    rows = shared.select("signature", "node").join(sizes, "signature").join(free, "node")
    odd = F.col("signature").bitwiseAND(F.lit(1)) == 1
    order = Window.partitionBy("node", odd).orderBy(F.desc("n"), F.desc("signature"))
    rows = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") > F.when(odd, F.col("odd")).otherwise(F.col("even")))
    return rows.select("signature", "node", "n")


def _across(shared: DataFrame, found: DataFrame) -> DataFrame:
    """``signature, node, component`` of the signatures whose nodes lie in several components."""
    placed = shared.select("signature", "node").join(found, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    range_ = placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    # Written out, so that the join deals both sides anew and Spark can split a hot signature.
    split = store(range_.filter("low <> high").select("signature", "low"), "split")
    return store(placed.join(split, "signature"), "across")


def _pairs(one: Column, two: Column, rows: DataFrame) -> DataFrame:
    return rows.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()


def _all_pairs(left: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Every pair of nodes that shares a signature across components and whose parity bits allow a link.

    Sets differ in at least as many grams as parity bits, so a pair that differs in more bits than
    its sizes allow is no link; the join's condition drops it before it becomes a row.
    """
    rows = left.select("signature", "node", "component").join(bits.select("node", "n", *PARITIES), "node")
    rows = store(rows, "parities")
    one, two = (rows.select("signature", *(F.col(c).alias(side + c) for c in rows.columns if c != "signature")) for side in "ab")
    turned = sum((F.bit_count(F.col("a" + p).bitwiseXOR(F.col("b" + p))) for p in PARITIES), F.lit(0))
    allowed = (F.col("an") + F.col("bn")) * (100 - percent)
    apart = F.greatest(turned, F.abs(F.col("an") - F.col("bn")))
    close = (F.col("anode") < F.col("bnode")) & (F.col("acomponent") != F.col("bcomponent")) & (apart * (100 + percent) <= allowed)
    one, two = one.withColumnRenamed("signature", "of_a"), two.withColumnRenamed("signature", "of_b")
    met = one.join(two, (F.col("of_a") == F.col("of_b")) & close)
    return met.select(F.col("anode").alias("a"), F.col("bnode").alias("b")).distinct()


def _close(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs that the wide parity bits still allow: large sets fill the few bits used before."""
    for side in "ab":
        own = bits.select(F.col("node").alias(side), F.col("n").alias(side + "n"), F.col("wide").alias(side + "wide"))
        pairs = pairs.join(own, side)
    turned = F.aggregate(
        F.zip_with("awide", "bwide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    allowed = (F.col("an") + F.col("bn")) * (100 - percent)
    return pairs.filter(turned * (100 + percent) <= allowed).select("a", "b")


def keep_first(docs: DataFrame, key="doc_id", text="text", size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of the smallest key of each component, all columns as they are.

    A document without words, or with a null key and no partner that has one, stays. Of rows that agree in key and text
    one stays.
    """
    found = join_components(docs, key, text, size, percent)
    first = found.filter(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    first = first.select(F.col("doc_id").alias("__first")).distinct()
    kept = docs.join(first, F.col(key).eqNullSafe(F.col("__first")), "left_semi")
    doubled = docs.groupBy(key).count().filter("count > 1")
    return kept if doubled.isEmpty() else kept.dropDuplicates([key, text])
