"""The Jaccard join against all pairs on small tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import jaccard
from opinara.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=4):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, percent=85, size=4):
    """doc_id to (n_shingles, component) by union of all linked pairs; candidates share a shingle."""
    sets = {i: shingles(t, size) for i, t in rows}
    holders = {}
    for i, grams in sets.items():
        for gram in grams:
            holders.setdefault(gram, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, grams in sets.items():
        shared = {}
        for gram in grams:
            for j in holders[gram]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, common in shared.items():
            if 100 * common >= percent * (len(grams) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_all_pairs_on_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    expected = brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert result(jaccard.join_components(docs)) == expected
    assert sum(c != i for i, (_, c) in expected.items()) > 5


def test_equals_all_pairs_near_the_threshold(spark):
    """Copies with as many edits as the threshold just allows or just forbids, of many lengths."""
    dice = random.Random(3)
    rows = []
    for _ in range(60):
        length = dice.choice([1, 3, 4, 5, 8, 12, 20, 40, 90, 200, 400])
        words = [f"w{dice.randrange(5000)}" for _ in range(length)]
        for _ in range(6):
            copy = list(words)
            for _ in range(dice.randint(0, max(1, length // 22))):
                copy[dice.randrange(length)] = f"w{dice.randrange(5000)}"
            cut = dice.randint(0, max(0, length // 12))
            rows.append((len(rows), " ".join(copy[cut:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows)
    assert result(jaccard.join_components(docs)) == expected
    assert len({c for _, c in expected.values()}) < len(rows) - 50


def test_signatures_bring_linked_sets_together():
    dice = np.random.default_rng(5)
    ends = jaccard.bands()
    for size in (7, 13, 30, 77, 250, 1000):
        for _ in range(60):
            base = np.unique(dice.integers(0, 1 << 63, size, dtype=np.uint64))
            gone = dice.integers(0, jaccard.difference(len(base)) + 1)
            new = jaccard.difference(len(base)) - gone
            other = np.unique(np.concatenate([base[gone:], dice.integers(0, 1 << 63, new, dtype=np.uint64)]))
            common = len(np.intersect1d(base, other))
            if 100 * common >= 85 * (len(base) + len(other) - common) and len(base) != common:
                one, two = jaccard.signatures(base, ends), jaccard.signatures(other, ends)
                assert len(np.intersect1d(one, two))


def test_odd_rows(spark):
    rows = [(5, None, "x"), (4, "", "y"), (3, " \t\n", "z"), (2, "One two", "a"), (1, "one TWO", "b"), (7, "one two three four", None), (None, "One two", "n"), (9, "same same same same same", "r"), (9, "same same same same same", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted(map(tuple, jaccard.join_components(docs).collect()), key=str)
    assert got == sorted([(5, 0, 5), (4, 0, 4), (3, 0, 3), (2, 1, 1), (1, 1, 1), (7, 1, 7), (None, 1, 1), (9, 1, 9), (9, 1, 9)], key=str)
    assert jaccard.join_components(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, j) for j in range(501, 560)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)}


def test_long_words_that_a_polynomial_cannot_tell_apart(spark):
    # The Thue-Morse word and its complement hash alike modulo 2^64 for every base and letters.
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"one two {word} three"), (4, f"one two {other} three"), (5, word)]
    found = jaccard.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_long_texts_are_hashed_in_parts(monkeypatch):
    from opinara.llm import kernels

    dice = random.Random(8)
    text = " \n".join("".join(dice.choice("abcé") for _ in range(dice.choice([1, 3, 9, 200]))) for _ in range(4000)) + "  "
    data = np.frombuffer(text.encode(), np.uint8)
    slab = kernels.Slab(0, data, np.array([0, len(data)]))
    (_, whole), = jaccard.shingle_sets(slab, 4, 0)
    for limit in (64, 1000, len(data) - 1):
        parts = [p.data.tobytes() for p in kernels.blank_cuts(slab, limit)]
        assert b"".join(parts) == data.tobytes() and sum(len(p.split()) for p in parts) == 4000 and (limit > 1000 or len(parts) > 1)
        monkeypatch.setattr(kernels.blank_cuts, "__defaults__", (limit,))
        monkeypatch.setattr(jaccard, "GRAM_STEP", limit)
        (_, found), = jaccard.shingle_sets(slab, 4, 0)
        assert np.array_equal(found, whole) and len(whole) == len(shingles(text))


def test_one_long_text_and_its_copy(spark):
    words = [f"w{i * 7919 % 999983:x}" for i in range(8_000_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[100:])), (3, " ".join(words[:500_000]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(rows[0][1]) > 50 << 20
    assert {r.doc_id: r.component_id for r in jaccard.join_components(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_whole_sets_are_joined_only_for_pairs_that_the_bits_allow(spark, small_dir, monkeypatch):
    """Pairs with hubs as well: the sets of a pair that its parity bits rule out are not shuffled."""
    ruled_out, true = [], jaccard.verified

    def watched(pairs, sets, percent):
        ruled_out.append(pairs.exceptAll(jaccard._close(pairs, sets, percent)).count())
        return true(pairs, sets, percent)

    monkeypatch.setattr(jaccard, "verified", watched)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    # A text and its halves share parts, but are no near copies.
    halves = docs.selectExpr("doc_id + 100000 as doc_id", "substring(text, 1, cast(length(text) * 0.7 as int)) as text")
    jaccard.keep_first(docs.select("doc_id", "text").union(halves), size=5, percent=80).count()
    assert ruled_out == [0, 0]


def test_whole_sets_are_made_for_the_nodes_of_close_pairs_only(spark, small_dir, monkeypatch):
    """A set that its bits rule out as a partner is never written; it was stored for each node with a shared signature."""
    made, true = [], jaccard.verified

    def watched(pairs, sets, percent):
        asked = pairs.selectExpr("a as node").union(pairs.select("b")).distinct()
        made.append((sets.select("node").exceptAll(asked).count(), asked.exceptAll(sets.select("node")).count()))
        return true(pairs, sets, percent)

    monkeypatch.setattr(jaccard, "verified", watched)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    halves = docs.selectExpr("doc_id + 100000 as doc_id", "substring(text, 1, cast(length(text) * 0.7 as int)) as text")
    jaccard.join_components(docs.union(halves)).count()
    assert made == [(0, 0), (0, 0)]


def test_a_stored_table_leaves_no_shuffle_files(spark):
    import time

    from opinara.llm.frames import SHUFFLE_CLEANUP, store

    disk, before = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), spark.conf.get(SHUFFLE_CLEANUP, None)
    count = lambda: sum(".data" in (name := disk.getAllFiles().apply(i).getName()) and name.startswith("shuffle_") for i in range(disk.getAllFiles().size()))
    old = count()
    stored = store(spark.range(5000).repartition(7).groupBy((F.col("id") % 1000).alias("k")).count(), "test")
    for _ in range(50):
        if count() <= old:
            break
        time.sleep(0.1)
    assert count() <= old and stored.count() == 1000
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_long_texts_that_share_a_passage_are_no_pairs(spark, monkeypatch, size, percent):
    """Sets of this size turn so many of the few bits that these allow any pair."""
    dice = random.Random(size)
    passage = [f"p{i}" for i in range(400)]
    texts = [passage + [f"w{k}x{dice.randrange(10**9)}" for _ in range(3200)] for k in range(30)]
    texts += [[w if dice.random() > 0.01 else f"new{dice.randrange(10**9)}" for w in text] for text in texts[:6]]
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    seen = []

    def counted(left, bits, percent, all_pairs=jaccard._all_pairs):
        pairs = all_pairs(left, bits, percent)
        seen.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "_all_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = result(jaccard.join_components(docs, size=size, percent=percent))
    assert found == brute_force(rows, percent, size)
    assert sum(c != i for i, (_, c) in found.items()) == 6
    assert seen[0] <= 6


@pytest.mark.parametrize("percent", [85, 80])
def test_linked_sets_share_more_signatures_than_either_can_do_without(percent):
    dice, ends = np.random.default_rng(percent), jaccard.bands(percent)
    for n in (60, 700, 1100, 3000, 5000):
        for _ in range(10):
            base = dice.integers(0, 1 << 63, n).astype(np.uint64)
            gone = int(dice.integers(0, jaccard.difference(n, percent) // 2))
            new = dice.integers(0, 1 << 63, gone).astype(np.uint64)
            other = np.concatenate([base[gone:], new])
            assert 100 * (n - gone) >= percent * (n + gone)
            one, two = (set(jaccard.signatures(x, ends, percent).tolist()) for x in (base, other))
            bands = {int(np.searchsorted(ends, len(x))) for x in (base, other)}
            for tag in range(max(bands), min(bands) + 2):  # both sign in these
                common = sum(s & 1 == tag & 1 for s in one & two)
                assert common > max(jaccard.dispensable(x, ends, percent)[tag & 1] for x in (base, other))
