"""Counts and base scores against plain counting; the class model by its sums, gradients and held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.llm import frames, lm_scoring, tokens
from opinara.llm.frames import table

SCHEMA = "doc_id long, text string"


def held_out(key):
    return zlib.crc32(("null" if key is None else str(key)).encode()) % 7 == 2


def words_of(text):
    return [word.decode() for word in (text or "").encode().lower().split()] + [None]


def base_scores(rows):
    counts = Counter()
    for key, text in rows:
        if not held_out(key):
            counts.update(words_of(text))
    total, distinct = sum(counts.values()), len(counts)
    for key, text in rows:
        words = words_of(text)
        score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        yield key, held_out(key), len(words), sum(counts[w] > 0 for w in words), total, score


def close(found, want):
    found = sorted(map(tuple, found), key=str)
    want = sorted(want, key=str)
    assert [row[:5] for row in found] == [row[:5] for row in want]
    assert np.allclose([row[5] for row in found], [row[5] for row in want], rtol=1e-9)


def odd_rows():
    dice = random.Random(4)
    pool = ["the", "The", "of.", "é", "Éa", *(f"w{i}" for i in range(300))]
    rows = [(dice.choice([None, *range(60)]), " ".join(dice.choices(pool, k=dice.randint(0, 80)))) for _ in range(200)]
    return [*rows, (1, None), (2, ""), (3, " \n\t"), (4, "x" * 5000), (9, "only once here"), (9, "only once here")]


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]


@pytest.mark.parametrize("head", [0, 5, 1 << 18])
def test_base_scores_equal_plain_counts(spark, head):
    """Whether a count is known to the tasks or joined."""
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs = docs.withColumns({c: F.lit("x") for c in ("row", "word", "n_train", "codes", "first", "score", "held_out")})
    close(lm_scoring.score_documents(docs, head=head, own=20, tails=16).select(*COLUMNS).collect(), base_scores(rows))


@pytest.mark.parametrize("rows", [[], [(9, "a b a")], [(k, "a b") for k in range(40) if held_out(k)]])
def test_tables_with_little_to_learn_from(spark, rows):
    found = lm_scoring.score_documents(spark.createDataFrame(rows, SCHEMA), own=4, tails=4).collect()
    close([row[:6] for row in found], base_scores(rows))
    assert all(math.isfinite(row.score) for row in found)


def small_model(rows, own=5, tails=4):
    counts = Counter(w for _, text in rows for w in words_of(text) if w)
    words = sorted(counts)
    data, places = lm_scoring._packed(words)
    key = tokens.keys(data, places[:-1], places[1:])
    n = np.array([counts[w] for w in words])
    kinds = own + lm_scoring.tail_class(data, places[:-1], places[1:], tails)
    kinds[np.argsort(-n, kind="stable")[:own]] = np.arange(own)
    sizes = np.bincount(kinds, n, own + tails + 1).astype(np.int64) + 1
    turn = np.argsort(key)
    return lm_scoring.Vocabulary(key[turn], n[turn], kinds[turn], own, tails, sizes, int(n.sum()), len(n))


def test_probabilities_of_all_classes_add_up_to_one():
    known = small_model(odd_rows())
    vectors = lm_scoring.Vectors.start(known)
    for part in (vectors.first, vectors.second, vectors.target):
        part *= 20
    model = lm_scoring.Model.of(known, vectors)
    every = np.arange(known.size)
    for first in (0, 3, known.size):
        for second in (1, known.end, known.size):
            logs = model.log_probability(every, np.full(known.size, first), np.full(known.size, second))
            assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_are_those_of_the_loss():
    known = small_model(odd_rows())
    trainer = lm_scoring.Trainer(known, lm_scoring.Vectors.start(known, 3), noise=4)
    dice = np.random.default_rng(1)
    target, first, second = (dice.integers(0, known.size, 30) for _ in range(3))
    noise = np.array([0, 2, 2, known.end])
    v = trainer.vectors
    parts = (v.first, v.second, v.target, v.bias)
    for part in parts:
        part[...] = dice.normal(0, 0.5, part.shape)

    def loss():
        context = v.first[first].astype(float) + v.second[second]
        real = (context * v.target[target]).sum(1) + v.bias[target] - trainer.log_share[target]
        false = context @ v.target[noise].T + v.bias[noise] - trainer.log_share[noise]
        return (np.log1p(np.exp(-real)) + np.log1p(np.exp(false)).sum(1)).mean()

    for part, found in zip(parts, trainer.gradients(target, first, second, noise)):
        for place in [tuple(dice.integers(0, s) for s in part.shape) for _ in range(12)]:
            kept = part[place]
            part[place] = kept + 1e-2
            up = loss()
            part[place] = kept - 1e-2
            down = loss()
            part[place] = kept
            assert found[place] == pytest.approx((up - down) / 2e-2, abs=2e-4)


@pytest.mark.parametrize("limit", [10, 100])
def test_long_texts_in_pieces_keep_their_contexts(monkeypatch, limit):
    rows = odd_rows()
    known = small_model(rows)
    column = pa.array([text or "" for _, text in rows])

    def run():
        seen = [[] for _ in rows]
        sums = np.zeros((len(rows), 4))
        for piece in lm_scoring.pieces_as_classes(column, known):
            first, second = lm_scoring.contexts(piece.target, piece.starts, piece.before_one, piece.before_two)
            ends = np.append(piece.starts[1:], len(piece.target))
            for i, (start, end) in enumerate(zip(piece.starts, ends)):
                seen[piece.first + i] += zip(piece.target[start:end], first[start:end], second[start:end])
                sums[piece.first + i] += piece.n_tokens[i], piece.n_known[i], piece.base[i], piece.within[i]
        return seen, sums

    whole, sums = run()
    for text in whole:
        flat = [known.size, known.size, *(t for t, _, _ in text)]
        assert [(a, b) for _, a, b in text] == [(flat[i + 1], flat[i]) for i in range(len(text))]
    real = tokens.pieces
    monkeypatch.setattr(tokens, "pieces", lambda c: real(c, limit))
    pieces, in_pieces = run()
    assert pieces == whole and np.allclose(sums, in_pieces)


def test_model_beats_counts_on_held_out_texts(spark, small_dir):
    found = lm_scoring.score_documents(table(spark, "/root/testdata/sf0.01", "documents"))
    sums = found.filter("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert sums.score / sums.n > sums.base / sums.n + 0.1


def test_tasks_get_small_batches(spark):
    """Spark's own 64 MB are held several times over in each task."""
    before = spark.conf.get(frames.BATCH_KEY)
    spark.conf.unset(frames.BATCH_KEY)
    try:
        docs = spark.createDataFrame([(k, "a b c") for k in range(9)], "doc_id long, text string")
        assert lm_scoring.score_documents(docs).count() == 9
        assert spark.conf.get(frames.BATCH_KEY) == frames.BATCH_BYTES
    finally:
        spark.conf.set(frames.BATCH_KEY, before)
