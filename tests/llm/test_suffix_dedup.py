"""Two-stage suffix arrays against sorting, and the cuts against a table of all strings."""

import random

import numpy as np
import pytest

from opinara.llm import kernels, suffix_dedup, suffixes


@pytest.mark.parametrize("letters", [1, 2, 3, 26, 256])
def test_suffix_array_equals_sorting(letters):
    dice = np.random.default_rng(letters)
    for count in (0, 1, 2, 3, 17, 200, 900):
        text = dice.integers(0, letters, count).astype(np.uint8)
        raw = text.tobytes()
        order = suffixes.suffix_array(text, 1000)
        expected = sorted(range(count), key=lambda i: raw[i:])
        # Past the end the sort sees zero bytes, so only texts without them order fully.
        if letters > 3 and 0 in text:
            order, expected = ([i for i in o if 0 not in text[i:]] for o in (list(order), expected))
        elif 0 in text:
            order, expected = suffixes.suffix_array(text + 1, 1000), sorted(range(count), key=lambda i: raw[i:])
        assert list(order) == expected


def test_order_to_a_depth_and_common_prefixes():
    dice = np.random.default_rng(9)
    block = dice.integers(97, 100, 150).astype(np.uint8)
    text = np.concatenate([block, block, dice.integers(97, 100, 90).astype(np.uint8), block, block[:70]])
    raw = text.tobytes()
    order = suffixes.suffix_array(text, 40)
    heads = [raw[i : i + 40] for i in order]
    assert sorted(order) == list(range(len(text))) and heads == sorted(heads)
    full = suffixes.suffix_array(text, 600)
    shared = suffixes.common_prefixes(text, full, 40)
    for place in range(1, len(full)):
        one, two = raw[full[place - 1] :], raw[full[place] :]
        true = next((i for i, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))
        assert min(shared[place], 40) == min(true, 40)


def brute_force(texts, length=200):
    seen = {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for raw in raws:
        cut = np.zeros(len(raw) + 2, np.int64)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                cut[i] += 1
                cut[i + length] -= 1
        gone = np.cumsum(cut)[: len(raw)] > 0
        runs = int(np.count_nonzero(np.diff(np.concatenate([[False], gone])) & gone)) if len(raw) else 0
        out.append((len(raw), int(gone.sum()), runs, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


def expected_rows(rows):
    cuts = brute_force([t for _, t in rows])
    return sorted(((i, *cut) for (i, _), cut in zip(rows, cuts)), key=str)


@pytest.mark.parametrize("wide", [suffix_dedup.WIDE, 1])
def test_equals_all_strings_on_documents(spark, small_dir, wide):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = result(suffix_dedup.cut_repeated_bytes(docs, wide=wide))
    assert got == expected_rows(rows)
    assert sum(r[2] > 0 for r in got) > 10


@pytest.mark.parametrize("wide", [suffix_dedup.WIDE, 2])
def test_equals_all_strings_on_planted_passages(spark, wide):
    """Passages of 199 to 900 bytes, whole, cut, at edges, within one document, periodic, in any script."""
    dice = random.Random(1)
    letters = "abcdefghij klmnop é日"
    passages = ["".join(dice.choice(letters) for _ in range(n)) for n in (150, 199, 200, 201, 260, 400, 900)]
    passages += ["ab" * 150, "=" * 500, "x" * 199]
    rows = []
    for i in range(160):
        parts = ["".join(dice.choice(letters) for _ in range(dice.choice([0, 0, 10, 90, 300]))) for _ in range(3)]
        for place in (0, 1):
            passage = dice.choice(passages)
            start = dice.choice([0, 0, 1, 7, 60])
            parts[place] += passage[start : len(passage) - dice.choice([0, 0, 3, 40])]
        rows.append((i, "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(suffix_dedup.cut_repeated_bytes(docs, wide=wide)) == expected_rows(rows)


def test_odd_rows(spark):
    long = "".join(random.Random(2).choice("abcdef ") for _ in range(700))
    rows = [(1, None), (2, ""), (3, "short"), (None, long[:300] + "!"), (5, long), (5, long), (5, "z" + long[400:]), (6, "q" * 250)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, pos string")
    assert result(suffix_dedup.cut_repeated_bytes(docs)) == expected_rows(rows)
    assert suffix_dedup.cut_repeated_bytes(docs.limit(0)).count() == 0


def test_slabs_give_the_texts_back():
    import pyarrow as pa

    texts = ["", "a", "é" * 10, "", "bcd" * 5, ""]
    for limit in (1, 7, 1000):
        got = {}
        for slab in kernels.slabs(pa.array(texts)[1:], limit):
            for i in range(len(slab)):
                got[slab.first + i] = slab.data[slab.offsets[i] : slab.offsets[i + 1]].tobytes().decode()
        assert [got[i] for i in range(5)] == texts[1:]


def test_one_long_text_is_worked_through_in_windows(spark, monkeypatch):
    """64 MB in one text, with a passage at the border of two windows that stands in another text as well."""
    dice = np.random.default_rng(4)
    size, border = 64 << 20, 77 * kernels.SLAB_BYTES
    raw = dice.integers(97, 123, size).astype(np.uint8).tobytes()
    passage = raw[border - 150 : border + 250]
    docs = spark.createDataFrame([(1, raw.decode()), (2, "é" * 9 + passage.decode())], "doc_id long, text string")
    found = {r.doc_id: r for r in suffix_dedup.cut_repeated_bytes(docs).collect()}
    assert list(found[1].spans) == [border - 150, border + 250] and list(found[2].spans) == [18, 418]
    assert bytes(found[1].kept) == raw[: border - 150] + raw[border + 250 :]


def test_windows_find_the_anchors_of_the_whole():
    dice = np.random.default_rng(6)
    data = np.concatenate([dice.integers(97, 100, 9000), np.full(1500, 97), dice.integers(97, 123, 7000)]).astype(np.uint8)
    slab = kernels.Slab(0, data, np.array([0, len(data)]))
    whole = set(zip(*(c.tolist() for c in suffix_dedup.anchors_of(slab, 200, 96))))
    parts = set()
    for part, begin, first, last in kernels.windows(slab, 400, 1000):
        row, places, *rest = suffix_dedup.anchors_of(part, 200, 96)
        own = (places >= first) & (places < last)
        parts |= set(zip(*(c[own].tolist() for c in (row, places + begin, *rest))))
    assert parts == whole


def test_spans_that_touch_are_one():
    edges = suffix_dedup.merged(np.array([30, 0, 10, 50, 52]), np.array([40, 12, 30, 60, 55]))
    assert edges.tolist() == [0, 40, 50, 60] and suffix_dedup.merged(np.zeros(0, int), np.zeros(0, int)).tolist() == []


def test_a_place_meets_one_row_however_many_strings_its_context_has(spark):
    """Near copies under one anchor: strings by the hundred, and as many places; the join must not multiply them."""
    places = spark.createDataFrame([(d, 1000 + d, 7, 8) for d in range(40)] + [(99, 5, 7, 9)], "doc long, pos int, anchor long, context long")
    strings = [(7, 8, low, low + 200) for low in range(-100, 0)] + [(7, 8, 150, 160), (7, 9, 0, 200)]
    found = spark.createDataFrame(strings, "anchor long, context long, low int, high int")
    merged = {(r.anchor, r.context): list(r.edges) for r in suffix_dedup.by_context(found).collect()}
    assert merged == {(7, 8): [-100, 199], (7, 9): [0, 200]}
    got = {r.of: [tuple(s) for s in r.spans] for r in suffix_dedup.spans_of_places(places, found).collect()}
    assert got[99] == [(5, 205)] and got[3] == [(903, 1202)]
    assert sum(map(len, got.values())) == 41
