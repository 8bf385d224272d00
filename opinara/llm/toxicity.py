"""Toxicity from subword bags: embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the set of its character 3- to 5-grams with begin and end marks, and itself; each is hashed
to a row of one embedding table. A word's vector is the mean of its rows, a document's the mean of
the vectors of its distinct words and ``PADDING`` zero vectors, so that neither a word repeated over
and over nor a text of three words is judged by one vector. A linear softmax over two classes reads it. Embeddings and classifier are
trained together by gradient steps. A misspelling never seen shares most of its n-grams with the word meant.

Training takes a bounded sample of labelled documents, the first by a hash of the key: at most
``SAMPLE_ROWS`` per class and ``SAMPLE_BYTES`` in all. Texts of more than ``LONG_SHARE`` times an even share of
these bytes come after all others, the shorter first, so that no single text takes the place of many. A class
has half of the bytes, and what the other leaves of its half. Tasks cut the sample into sets of words,
the driver trains on these. The model's size is fixed by ``BUCKETS`` and ``WIDTH``. Scoring covers every
whole text: the logit is linear in the mean, so each word has one number, worked out once per task
as long as the bounded cache holds it.

The score sees the text alone. Labels are only learned from keys whose CRC-32 modulo ``FOLDS`` is not
0. Defined results: null and empty texts score as a text without words, by the bias; a null key hashes
as the text ``null``; labels that are null, or without document, are passed over; a key labelled more
than once counts as toxic if any label says so; without labels of both classes every score is the
share of toxic labels (0 if there are none). Every row is scored by itself, repeated ones alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.llm import kernels
from opinara.llm.frames import documents_of, map_batches

FOLDS, SAMPLE_ROWS, SAMPLE_BYTES = 5, 3000, 32 << 20
LONG_SHARE = 32
SHORTEST, LONGEST, BUCKETS, WIDTH = 3, 5, 1 << 17, 8
EPOCHS, BATCH, RATE, TABLE_RATE, SEED = 12, 128, 0.05, 10.0, 42
LEAST_DOCUMENTS, PADDING, CACHED_WORDS, PIECE_ROWS, PIECE_WORDS = 5, 10, 300_000, 500, 20_000
WORD = re.compile(r"[^\W_]+")
SCORED = "doc_id long, score double, predicted int"


def fold(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null"))) % FOLDS


def word_set(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all words' n-grams, one after the other, and how many each word has."""
    found = kernels.word_grams(words, np.zeros(len(words), np.uint64), LONGEST)
    owners, rows = [], []
    for n in range(SHORTEST, LONGEST + 1):
        at = found.step >= n - 1
        owners.append(found.owner[at])
        rows.append(found.hashes[n][at])
    # The word as a whole: the sum of its letters' hashes by place.
    placed = kernels.mix(found.hashes[1] + found.step.astype(np.uint64) * kernels.BASE)
    owners.append(np.arange(len(words)))
    rows.append(kernels.mix(np.add.reduceat(placed, np.flatnonzero(found.step == 0))) if words else placed[:0])
    owner = np.concatenate(owners)
    turn = np.argsort(owner, kind="stable")
    return (np.concatenate(rows)[turn] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    """One number per table row, and the bias: all that a trained softmax of two classes needs."""

    rows: np.ndarray
    bias: float

    def word_logits(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        rows, counts = subwords(words)
        return np.add.reduceat(self.rows[rows], np.cumsum(counts) - counts) / counts


@dataclass
class Bags:
    """Words of labelled documents as (document, word, weight of the word in the mean)."""

    doc: np.ndarray
    word: np.ndarray
    share: np.ndarray
    words: list[str]
    labels: np.ndarray

    @staticmethod
    def of(rows: list[tuple[list[str], int]]) -> "Bags":
        index: dict[str, int] = {}
        doc, word, share = [], [], []
        for number, (words, _) in enumerate(rows):
            doc += [number] * len(words)
            word += [index.setdefault(w, len(index)) for w in words]
            share += [1 / (len(words) + PADDING)] * len(words)
        return Bags(np.array(doc, np.int64), np.array(word, np.int64), np.array(share), list(index), np.array([r[1] for r in rows], np.int64))


def train(bags: Bags, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    dice = np.random.default_rng(seed)
    count = len(bags.labels)
    toxic = bags.labels.mean() if count else 0.0
    if toxic in (0.0, 1.0) or not bags.words:
        even = np.clip(toxic, 1e-9, 1 - 1e-9)
        return Model(np.zeros(BUCKETS), float(np.log(even / (1 - even))))
    # Piece by piece: the hashes on the way there take many times the rows they lead to.
    pieces = [subwords(bags.words[i : i + PIECE_WORDS]) for i in range(0, len(bags.words), PIECE_WORDS)]
    rows, sizes = (np.concatenate(part) for part in zip(*pieces))
    del pieces
    ends = np.cumsum(sizes)
    # N-grams of few documents stay at zero, and so say nothing, like those never seen.
    in_words = np.bincount(bags.word, minlength=len(bags.words))
    learned = np.bincount(rows, np.repeat(in_words, sizes), BUCKETS) >= LEAST_DOCUMENTS
    table = np.zeros((BUCKETS, WIDTH), np.float32)
    weights = dice.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    bias = np.log(np.array([1 - toxic, toxic], np.float32))
    steps = [Momentum(p, r) for p, r in ((table, TABLE_RATE), (weights, RATE), (bias, RATE))]
    first = np.searchsorted(bags.doc, np.arange(count + 1))
    for _ in range(epochs):
        order = dice.permutation(count)
        for start in range(0, count, BATCH):
            batch = order[start : start + BATCH]
            lengths = first[batch + 1] - first[batch]
            at = np.repeat(first[batch] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            doc = np.repeat(np.arange(len(batch)), lengths)
            used, word = np.unique(bags.word[at], return_inverse=True)
            size = sizes[used]
            entries = rows[np.repeat(ends[used] - np.cumsum(size), size) + np.arange(size.sum())]
            owner = np.repeat(np.arange(len(used)), size)
            # Forward: rows to words to documents to classes.
            vectors = np.stack([np.bincount(owner, table[entries, d], len(used)) for d in range(WIDTH)], 1) / np.maximum(size, 1)[:, None]
            parts = vectors[word] * bags.share[at][:, None]
            means = np.stack([np.bincount(doc, parts[:, d], len(batch)) for d in range(WIDTH)], 1)
            logits = means @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            # Backward, the same way back.
            error = p
            error[np.arange(len(batch)), bags.labels[batch]] -= 1
            error /= len(batch)
            to_means = error @ weights.T
            to_parts = to_means[doc] * bags.share[at][:, None]
            to_words = np.stack([np.bincount(word, to_parts[:, d], len(used)) for d in range(WIDTH)], 1) / np.maximum(size, 1)[:, None]
            to_table = np.stack([np.bincount(entries, to_words[owner, d], BUCKETS) for d in range(WIDTH)], 1)
            to_table *= learned[:, None]
            for step, gradient in zip(steps, (to_table, means.T @ error, error.sum(0))):
                step.apply(gradient.astype(np.float32))
    read = weights[:, 1] - weights[:, 0]
    return Model((table @ read).astype(np.float64), float(bias[1] - bias[0]))


class Momentum:
    """Steps along the mean gradient, scaled by the largest entry the whole parameter has seen of late.

    One scale for all rows keeps n-grams that many documents share ahead of those of a single one;
    a scale for each row, as in Adam, would let a document be learned by its own rare n-grams.
    """

    def __init__(self, parameter: np.ndarray, rate: float):
        self.parameter, self.rate, self.largest = parameter, rate, 0.0
        self.mean = np.zeros_like(parameter)

    def apply(self, gradient: np.ndarray) -> None:
        self.mean += 0.1 * (gradient - self.mean)
        self.largest = max(0.99 * self.largest, float(np.abs(gradient).max()), 1e-12)
        self.parameter -= self.rate / self.largest * self.mean


def learnable(labels: DataFrame) -> DataFrame:
    """``id, label``: one label a key, of the folds that may be learned from."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    wanted = wanted.filter("id is not null and toxic in (0, 1)").filter(fold("id") != 0)
    return wanted.groupBy("id").agg(F.max("toxic").alias("label"))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> DataFrame:
    """``id, text, label`` of the labelled documents to learn from, the least text of a key."""
    wanted = learnable(labels)
    sizes = docs.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.octet_length("text")).alias("size"))
    known = wanted.join(sizes, "id").withColumn("place", F.xxhash64("id"))
    known = known.withColumn("over", F.when(F.col("size") > size // (2 * rows) * LONG_SHARE, F.col("size")).otherwise(0))
    order = ("over", "place", "id")
    classes = [known.filter(F.col("label") == c).orderBy(*order).limit(rows) for c in (0, 1)]
    # From here on at most 2 * rows rows of five numbers.
    before = Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = classes[0].union(classes[1]).withColumn("upto", F.sum("size").over(before))
    other = F.coalesce(F.sum("size").over(Window.partitionBy()) - F.sum("size").over(Window.partitionBy("label")), F.lit(0))
    taken = found.withColumn("other", other).filter(F.col("upto") <= size - F.least(F.col("other"), F.lit(size // 2)))
    chosen = docs.join(F.broadcast(taken.select("id", "label")), F.col("doc_id") == F.col("id"))
    # One row a key, combined per task: a key may be that of very many rows.
    return chosen.groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, key="doc_id", text="text") -> Model:
    """``labels`` has ``doc_id, toxic``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pa.array([sorted(word_set(t.as_py())) for t in batch.column(1)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), words, batch.column(2)], ["id", "words", "label"])

    chosen = sample(documents_of(docs, key, text), labels)
    bags = map_batches(chosen, run, "id long, words array<string>, label int").toArrow()
    # In one order, whatever the partitions, so that training repeats itself.
    rows = sorted(zip(*(bags.column(i).to_pylist() for i in range(3))))
    bags = Bags.of([(words, label) for _, words, label in rows])
    del rows
    model = train(bags)
    # The sample takes the classes as it finds them; scores answer to their share among all labels.
    toxic, known = learnable(labels).agg(F.sum("label"), F.count(F.lit(1))).first()
    taken, count = int(bags.labels.sum()), len(bags.labels)
    if 0 < taken < count:
        model.bias += float(np.log(toxic / (known - toxic)) - np.log(taken / (count - taken)))
    return model


def scored(docs: DataFrame, model: Model, key="doc_id", text="text") -> DataFrame:
    """``doc_id, score, predicted`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = np.array(scorer.scores(t.as_py() for t in batch.column(1)), np.float64)
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    return map_batches(documents_of(docs, key, text), run, SCORED)


def keep_clean(docs: DataFrame, model: Model, text="text") -> DataFrame:
    """The rows whose text is not predicted toxic, all columns as they are."""
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = scorer.scores(t.as_py() or "" for t in batch.column(place))
            yield batch.filter(pa.array([score < 0.5 for score in scores], pa.bool_()))

    return map_batches(docs, run, docs.schema)


class Scorer:
    """Scores texts one by one, remembering the words it has met."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def scores(self, texts) -> list[float]:
        out, texts = [], iter(texts)
        while piece := [word_set(text) for text in islice(texts, PIECE_ROWS)]:
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            # The new words of many documents at once: numpy pays off on long arrays only.
            new = list(set().union(*piece) - self.known.keys())
            if new:
                self.known.update(zip(new, self.model.word_logits(new).tolist()))
            means = [sum(map(self.known.__getitem__, words)) / (len(words) + PADDING) for words in piece]
            out += (1 / (1 + np.exp(-np.clip(np.array(means) + self.model.bias, -500, 500)))).tolist()
        return out
