"""The FM-index, its shards and the groups of spelling variants against plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinara.llm import variants
from opinara.llm.fm_index import Index

SCHEMA = "doc_id long, text string"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def drawn(dice, letters, count):
    return sorted({"".join(dice.choices(letters, k=dice.randint(5, 9))) for _ in range(count)})


@pytest.mark.parametrize("letters", ["ab", "abcdeéÿ"])
@pytest.mark.parametrize("count", [0, 1, 3, 40, 150])
def test_index_finds_all_words_one_edit_away(letters, count):
    dice = random.Random(count)
    known, asked = drawn(dice, letters, count), drawn(dice, letters + "z", 60)
    asked = sorted({*known, *asked})
    index = Index(known)
    for front in (True, False):
        found = {(asked[q], known[w]) for q, w in zip(*index.one_edit(asked, front))}
        half = {a: a[: len(a) // 2] if front else a[len(a) // 2 :] for a in asked}
        fits = str.startswith if front else str.endswith
        assert found == {(a, b) for a in asked for b in known if one_edit(a, b) and fits(b, half[a])}


def test_index_takes_long_words():
    long = "ab" * 600
    known = sorted([long, long + "c", "x" + long[1:], long[:500] + long[501:]])
    index = Index(known)
    found = {p for front in (True, False) for p in zip(*(side.tolist() for side in index.one_edit(known, front)))}
    assert found == {(i, j) for i, a in enumerate(known) for j, b in enumerate(known) if one_edit(a, b)}


@pytest.mark.parametrize("shard_words", [3, 40, 10_000])
def test_shards_lose_no_pair(spark, shard_words):
    dice = random.Random(5)
    words = drawn(dice, "abc", 220) + ["thethe" + c for c in "abcdefgh"]
    table = spark.createDataFrame([(w, dice.randint(3, 50)) for w in words], "word string, n long")
    n = dict(map(tuple, table.collect()))
    found = Counter(map(tuple, variants.near_words(table, shard_words).collect()))
    assert found == Counter((a, b, n[b]) for a in words for b in words if one_edit(a, b))


def brute_force(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best and counts[best] >= 2 * counts[word] else None
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        yield word, counts[word], len(near[word]), form[word], counts.get(form[word]), root


def odd_rows():
    dice = random.Random(8)
    words = drawn(dice, "abÀé", 60)
    rows = [(dice.choice([None, *range(40)]), " ".join(dice.choices(words, k=dice.randint(0, 60))).title()) for _ in range(150)]
    # Chains: each spelling twice as frequent as the one before.
    chain = ["vwxyz", "vwxya", "vwxba", "vwcba", "vdcba", "edcba"]
    rows += [(i, " ".join([word] * (3 << i))) for i, word in enumerate(chain)]
    return [*rows, (1, None), (2, ""), (3, "a×b÷c 1é2 \n\t"), (4, "long" * 3000 + "." + "word-" * 200_000)] + [(7, "Twice twice")] * 9


def test_groups_equal_brute_force(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs = docs.withColumns({c: F.lit("x") for c in ("word", "n", "near", "form", "root", "shard", "front", "salt")})
    found = variants.variant_groups(docs, shard_words=20).select("word", "n", "n_near", "form", "form_n", "root")
    want = sorted(brute_force(rows), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert any(form and root != form for *_, form, _, root in want)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "")]])
def test_no_words_no_rows(spark, rows):
    assert variants.variant_groups(spark.createDataFrame(rows, SCHEMA)).count() == 0
