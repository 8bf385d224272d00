"""Language-model scores: a log-bilinear model over classes of tokens, trained by contrast with noise.

Tokens are words of lower-case A to Z, and one end a document. Spark counts them over all documents,
with how many stand in those to learn from. A token's probability is that of its class after the two
classes before it, times its share of the class:

* The ``OWN`` most frequent tokens and the end are classes of their own. Every other token belongs to
  one of ``TAILS`` classes by its last three bytes, known or not; in a class, a token counts one more than
  it was seen, and all that were never seen share one count.
* The class model has a vector for each class at each place of the context and as a target; the score of
  a target is the product of its vector with the sum of the context's, and a bias. It is trained in
  numpy: each target against ``NOISE`` classes drawn from the class counts, as a logistic question
  which of them is real. A start is made on the driver, on at most ``SAMPLE_ROWS`` documents of at most
  ``SAMPLE_BYTES`` each. From there every task learns from all its documents, and Spark averages the
  vectors, weighted by tokens; a task hands on one set of vectors, whatever it has read.
* Matrix products of the exponentials of both context tables give the sum over all targets for every pair
  of contexts at once, so each log probability is normalised over the whole vocabulary.

Vectors and the normaliser are of fixed size. Counts of tokens are not, so only the most frequent (at
most ``HEAD``, counted over all documents) are sent to tasks, as sorted hashes. The counts of all others
are joined, once for each distinct token of a document; none of these can be frequent, so no key of
that join is hot. A token met in a task is known by a 64-bit hash of its bytes; tables hold the tokens.

Defined results: a null text is an empty one, whose only token is the end; a null key hashes as the
text ``null``; rows are scored by themselves, exact repeats alike, and learned from as often as they
occur; without a document to learn from N and V are 0 and all classes alike; an empty table gives an
empty result; a long text is read in pieces. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.llm import tokens
from opinara.llm.frames import map_batches, small_batches, store, text_of

FOLDS, HELD_OUT = 7, 2
HEAD, OWN, TAILS = 1 << 18, 1023, 1024
WIDTH, NOISE, BATCH, RATE, SEED = 8, 24, 4096, 0.1, 42
# The start on the driver: smaller steps, more noise, some rounds.
SAMPLE_ROWS, SAMPLE_BYTES, START_NOISE, START_BATCH, START_RATE, EPOCHS = 4000, 16_384, 64, 1024, 0.2, 2
STEP = 1 << 20  # targets scored at a time
BINS = 16  # of a doubling of the count
SUFFIX = 3
LN10 = float(np.log(10))


def fold(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null"))) % FOLDS


def documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    row = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return row.withColumn("held_out", fold("doc_id") == HELD_OUT).withColumn("row", F.monotonically_increasing_id())


def tail_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tails: int) -> np.ndarray:
    """By the last bytes of each span."""
    suffix = np.maximum(ends - SUFFIX, starts)
    return (tokens.keys(data, suffix, ends) % np.uint64(tails)).astype(np.int64)


# Counting


def token_counts(rows: DataFrame) -> DataFrame:
    """``word, n_all, n_train`` of every token; the empty word is the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = tokens.Tally()
        ends = np.zeros(2, np.int64)
        names = ["word", "n_all", "n_train"]
        for batch in batches:
            train = ~np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            ends += len(train), train.sum()
            for piece in tokens.pieces(batch.column(0)):
                found = tokens.spans(piece, tokens.blank_free(piece.data))
                one = np.ones(len(found.starts), np.int64)
                seen = train[piece.first + found.row].astype(np.int64)
                for full in tally.add(piece.data, found.starts, found.ends, [one, seen]):
                    yield pa.RecordBatch.from_arrays(full, names)
        for full in tally.drain():
            yield pa.RecordBatch.from_arrays(full, names)
        yield pa.RecordBatch.from_arrays([pa.array([""]), *(pa.array([int(n)]) for n in ends)], names)

    counted = map_batches(rows.select("text", "held_out"), run, "word string, n_all long, n_train long")
    return counted.groupBy("word").agg(F.sum("n_all").alias("n_all"), F.sum("n_train").alias("n_train")).filter("n_all > 0")


def least_of_head(counts: DataFrame, most: int) -> int:
    """The bin of counts from which on the tokens are at most ``most``."""
    bins = counts.groupBy(count_bin().alias("bin")).agg(F.count(F.lit(1)).alias("words"))
    upto = F.sum("words").over(Window.orderBy(F.desc("bin")))
    # At most BINS rows for each doubling.
    return bins.withColumn("upto", upto).filter(F.col("upto") <= most).agg(F.coalesce(F.min("bin"), F.lit(1 << 30))).first()[0]


def count_bin() -> Column:
    return F.floor(F.log2("n_all") * BINS).cast("int")


@dataclass
class Vocabulary:
    """What tasks know of tokens: the frequent ones, by sorted hashes, and how large each class is."""

    keys: np.ndarray
    counts: np.ndarray  # in the documents to learn from
    classes: np.ndarray
    own: int
    tails: int
    class_counts: np.ndarray  # tokens of each class, with the one for all unseen in a tail class
    total: int  # N
    distinct: int  # V

    def __post_init__(self):
        bits = max(int(len(self.keys)).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.buckets = np.append(np.searchsorted(self.keys, edges), len(self.keys))

    @property
    def end(self) -> int:
        return self.own + self.tails

    @property
    def size(self) -> int:
        return self.end + 1

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, class and count of each span; the count is -1 where it is not known here."""
        key = tokens.keys(data, starts, ends)
        # Hashes are even, so their first bits lead to within a few places of the sorted array.
        bucket = (key >> self.shift).astype(np.int64)
        at, stop = self.buckets[bucket], self.buckets[bucket + 1]
        kind = np.empty(len(key), np.int64)
        count = np.full(len(key), -1, np.int64)
        live = np.flatnonzero(at < stop)
        while len(live):
            here = at[live]
            hit = self.keys[here] == key[live]
            kind[live[hit]], count[live[hit]] = self.classes[here[hit]], self.counts[here[hit]]
            at[live] += 1
            live = live[~hit & (here + 1 < stop[live])]
        rest = np.flatnonzero(count < 0)
        kind[rest] = self.own + tail_class(data, starts[rest], ends[rest], self.tails)
        return key, kind, count


def _packed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    text = [w.encode() for w in words]
    data = np.frombuffer(b"".join(text) + bytes(tokens.WIDE), np.uint8).copy()
    return data, np.concatenate([[0], np.cumsum(list(map(len, text)))]).astype(np.int64)


def vocabulary(counts: DataFrame, head: int = HEAD, own: int = OWN, tails: int = TAILS) -> tuple[Vocabulary, DataFrame]:
    """Also the counts that tasks do not know. ``counts`` is a stored table."""
    least = least_of_head(counts.filter("word <> ''"), head)
    in_head = (count_bin() >= least) & (F.col("word") != "")
    frequent = counts.filter(in_head).orderBy("word").toArrow()
    words = frequent.column("word").to_pylist()
    n = frequent.column("n_train").to_numpy()
    data, places = _packed(words)
    key = tokens.keys(data, places[:-1], places[1:])
    kinds = own + tail_class(data, places[:-1], places[1:], tails)
    first = np.argsort(-n, kind="stable")[:own]
    first = first[n[first] > 0]
    kinds[first] = np.arange(len(first))

    # How many tokens, and how many different ones, each tail class has beside the frequent.
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = _packed(batch.column(0).to_pylist())
            kind = tail_class(data, places[:-1], places[1:], tails)
            sums = np.bincount(kind, batch.column(1).to_numpy(), tails).astype(np.int64)
            distinct = np.bincount(kind, minlength=tails)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(tails)), pa.array(sums), pa.array(distinct)], ["kind", "n", "words"])

    rare = counts.filter(~in_head & (F.col("word") != "") & (F.col("n_train") > 0)).select("word", "n_train")
    summed = map_batches(rare, classes, "kind long, n long, words long").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    sizes = np.zeros(own + tails + 1, np.int64)
    extra = np.zeros(own + tails + 1, np.int64)
    for row in summed.collect():  # one row a class
        sizes[own + row.kind], extra[own + row.kind] = row.n, row.words
    np.add.at(sizes, kinds, n)
    np.add.at(extra, kinds, (n > 0).astype(np.int64))
    total, distinct = counts.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.when(F.col("n_train") > 0, 1))).first()
    ends = counts.filter("word = ''").agg(F.coalesce(F.max("n_train"), F.lit(0))).first()[0]
    sizes[own + tails] = ends
    # In a tail class each known token counts one more than seen, and there is one for the unseen.
    sizes[own : own + tails] += extra[own : own + tails] + 1
    turn = np.argsort(key)
    found = Vocabulary(key[turn], n[turn], kinds[turn], own, tails, sizes, int(total), int(distinct))
    return found, rare


# Texts as classes

ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double, "
    "first int, second int, codes binary, word string, times long"
)
CODE = np.dtype("<u2")


def encoded(rows: DataFrame, known: Vocabulary) -> DataFrame:
    """A row for each document, or piece of a long one, and one for each of its tokens of unknown count.

    ``codes`` holds the classes, with ``first`` and ``second`` those one and two before; the sums leave
    out the tokens whose count is still to be joined.
    """
    shared = rows.sparkSession.sparkContext.broadcast(known)
    names = [part.split()[0] for part in ENCODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_as_classes(batch.column(2), shared.value):
                own = [batch.column(i).slice(piece.first, len(piece.starts)) for i in (0, 1, 3)]
                numbers = [pa.array(x) for x in (piece.n_tokens, piece.n_known, piece.base, piece.within)]
                before = [pa.array(x.astype(np.int32)) for x in (piece.before_one, piece.before_two)]
                none = [pa.nulls(len(own[0]), kind) for kind in (pa.string(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*own, *numbers, *before, piece.codes(), *none], names)
                if len(piece.times):
                    kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 2, *[pa.float64()] * 2, *[pa.int32()] * 2, pa.binary()]
                    none = [pa.nulls(len(piece.times), kind) for kind in kinds]
                    row = batch.column(0).take(pa.array(piece.first + piece.word_row))
                    yield pa.RecordBatch.from_arrays([row, *none, piece.words, pa.array(piece.times)], names)

    return map_batches(rows.select("row", "doc_id", "text", "held_out"), run, ENCODED)


@dataclass
class Classes:
    """Some texts, or part of one, as classes; an entry of each of the sums for each of them."""

    first: int  # row of the batch
    target: np.ndarray
    starts: np.ndarray  # of the texts in target
    before_one: np.ndarray
    before_two: np.ndarray
    n_tokens: np.ndarray
    n_known: np.ndarray
    base: np.ndarray
    within: np.ndarray
    words: pa.Array  # distinct tokens of unknown count by text
    word_row: np.ndarray
    times: np.ndarray

    def codes(self) -> pa.Array:
        offsets = np.append(self.starts, len(self.target)).astype(np.int32) * CODE.itemsize
        return pa.Array.from_buffers(pa.binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.target.astype(CODE))])


def pieces_as_classes(column: pa.Array, known: Vocabulary) -> Iterator[Classes]:
    begin = known.size  # a context only
    sizes = np.log10(known.class_counts[known.own : known.own + known.tails])
    ends_seen = int(known.class_counts[known.end])
    carried = (begin, begin)
    for piece in tokens.pieces(column):
        found = tokens.spans(piece, tokens.blank_free(piece.data))
        key, kind, count = known.lookup(piece.data, found.starts, found.ends)
        rows = len(piece)
        upto = np.searchsorted(found.row, np.arange(rows + 1))  # tokens before each text
        target = np.empty(len(kind) + piece.ended, np.int64)
        target[np.arange(len(kind)) + found.row] = kind
        target[upto[1 : piece.ended + 1] + np.arange(piece.ended)] = known.end
        starts = upto[:-1] + np.arange(rows)
        before = np.full((2, rows), begin)
        if piece.inside:
            before[:, 0] = carried
        if piece.ended < rows:
            last = np.concatenate([before[::-1, -1], target[starts[-1] :]])
            carried = (int(last[-1]), int(last[-2]))
        seen = np.maximum(count, 0)
        logs = np.log10(seen + 1.0)
        in_tail = kind >= known.own
        within = np.where(in_tail, logs, 0.0)
        within[in_tail] -= sizes[kind[in_tail] - known.own]
        closed = np.arange(rows) < piece.ended
        # Tokens of unknown count, once for each text.
        at = np.flatnonzero(count < 0)
        turn = np.lexsort((key[at], found.row[at]))
        at = at[turn]
        new = np.ones(len(at), bool)
        new[1:] = (key[at][1:] != key[at][:-1]) | (found.row[at][1:] != found.row[at][:-1])
        one = at[new]
        yield Classes(
            piece.first, target, starts, before[0], before[1],
            np.bincount(found.row, minlength=rows) + closed,
            np.bincount(found.row, seen > 0, rows).astype(np.int64) + (closed & (ends_seen > 0)),
            np.bincount(found.row, logs, rows) + closed * np.log10(ends_seen + 1.0),
            np.bincount(found.row, within, rows),
            tokens.strings(*tokens.gathered(piece.data, found.starts[one], found.ends[one])),
            found.row[one], np.diff(np.append(np.flatnonzero(new), len(at))),
        )


def contexts(target: np.ndarray, starts: np.ndarray, before_one: np.ndarray, before_two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each target; texts begin at ``starts`` with what was before them."""
    first, second = np.zeros_like(target), np.zeros_like(target)
    first[1:], second[2:] = target[:-1], target[:-2]
    full = starts < np.append(starts[1:], len(target))
    starts, before_one, before_two = starts[full], before_one[full], before_two[full]
    follow = starts + 1
    second[follow[follow < len(target)]] = before_one[follow < len(target)]
    first[starts], second[starts] = before_one, before_two
    return first, second


def stored_contexts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Targets, both contexts and starts from ``codes, first, second``."""
    codes = batch.column(0)
    _, places, values = codes.buffers()
    offsets = np.frombuffer(places, np.int32)[codes.offset : codes.offset + len(codes) + 1] // CODE.itemsize
    target = np.frombuffer(values, CODE)[offsets[0] : offsets[-1]].astype(np.int64) if values is not None else np.zeros(0, np.int64)
    starts = (offsets[:-1] - offsets[0]).astype(np.int64)
    return target, *contexts(target, starts, *(batch.column(i).to_numpy().astype(np.int64) for i in (1, 2))), starts


# The class model


@dataclass
class Vectors:
    """Of each class, as context one and two before (the last row is the begin), and as target."""

    first: np.ndarray
    second: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(known: Vocabulary, width: int = WIDTH, seed: int = SEED) -> "Vectors":
        dice = np.random.default_rng(seed)
        draw = [dice.normal(0, 0.1, (rows, width)).astype(np.float32) for rows in (known.size + 1, known.size + 1, known.size)]
        return Vectors(*draw, np.log(noise_of(known)).astype(np.float32))

    def packed(self) -> np.ndarray:
        """One row a vector; the bias follows a target's."""
        width = self.target.shape[1]
        out = np.zeros((len(self.first) + len(self.second) + len(self.target), width + 1), np.float64)
        out[: len(self.first), :width] = self.first
        out[len(self.first) : -len(self.target), :width] = self.second
        out[-len(self.target) :, :width] = self.target
        out[-len(self.target) :, width] = self.bias
        return out

    def unpacked(self, rows: np.ndarray) -> "Vectors":
        rows = rows.astype(np.float32)
        n, m, width = len(self.first), len(self.second), self.target.shape[1]
        return Vectors(rows[:n, :width], rows[n : n + m, :width], rows[n + m :, :width], rows[n + m :, width])


def noise_of(known: Vocabulary) -> np.ndarray:
    weights = known.class_counts + 1.0
    return weights / weights.sum()


class Trainer:
    """Noise-contrastive steps; those of one batch share the noise drawn. Rates fall as gradients add up."""

    def __init__(self, known: Vocabulary, vectors: Vectors, noise: int = NOISE, batch: int = BATCH, rate: float = RATE, squares: list[np.ndarray] | None = None, seed: int = SEED):
        self.vectors = Vectors(*(np.array(p, np.float32) for p in (vectors.first, vectors.second, vectors.target, vectors.bias)))
        self.share = noise_of(known)
        self.log_share = np.log(self.share * noise).astype(np.float32)
        self.edges = np.cumsum(self.share)
        self.noise, self.batch, self.rate = noise, batch, rate
        self.dice = np.random.default_rng(seed)
        parameters = (self.vectors.first, self.vectors.second, self.vectors.target, self.vectors.bias)
        # Going on from another trainer's sums, steps are as small as its last ones.
        self.squares = [np.array(s) for s in squares] if squares else [np.full(p.shape, 1e-6, np.float32) for p in parameters]
        self.seen = 0

    def learn(self, target: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        for start in range(0, len(target), self.batch):
            piece = slice(start, start + self.batch)
            self.step(target[piece], first[piece], second[piece])

    def gradients(self, target, first, second, noise) -> list[np.ndarray]:
        """Of the mean loss, for the four parameters."""
        v = self.vectors
        context = v.first[first] + v.second[second]
        own = v.target[target]
        real = np.einsum("ij,ij->i", context, own) + v.bias[target] - self.log_share[target]
        drawn = v.target[noise]
        false = context @ drawn.T + (v.bias[noise] - self.log_share[noise])
        # Chance that each is taken for what it is not.
        on_real = -1 / (1 + np.exp(np.clip(real, -30, 30))) / len(target)
        on_false = 1 / (1 + np.exp(-np.clip(false, -30, 30))) / len(target)
        to_context = on_real[:, None] * own + on_false @ drawn
        to_target = _summed(target, on_real[:, None] * context, v.target.shape)
        np.add.at(to_target, noise, on_false.T @ context)
        to_bias = np.bincount(target, on_real, len(v.bias))
        np.add.at(to_bias, noise, on_false.sum(0))
        return [_summed(first, to_context, v.first.shape), _summed(second, to_context, v.second.shape), to_target, to_bias.astype(np.float32)]

    def step(self, target: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        noise = np.minimum(np.searchsorted(self.edges, self.dice.random(self.noise)), len(self.edges) - 1)
        found = self.gradients(target, first, second, noise)
        v = self.vectors
        for parameter, gradient, squares in zip((v.first, v.second, v.target, v.bias), found, self.squares):
            squares += gradient * gradient
            parameter -= self.rate * gradient / np.sqrt(squares)
        self.seen += len(target)


def _summed(rows: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    places = (rows[:, None] * shape[1] + np.arange(shape[1])).ravel()
    return np.bincount(places, values.ravel(), shape[0] * shape[1]).reshape(shape).astype(np.float32)


def started(rows: DataFrame, known: Vocabulary) -> Trainer:
    """A trainer after a few rounds on a bounded sample: the common ground of all tasks."""
    fit = rows.filter(~F.col("held_out") & (F.octet_length("text") <= SAMPLE_BYTES))
    sample = fit.select("text", F.xxhash64("doc_id", "text").alias("place")).orderBy("place", "text").limit(SAMPLE_ROWS).toArrow()
    trainer = Trainer(known, Vectors.start(known), START_NOISE, START_BATCH, START_RATE)
    found = list(pieces_as_classes(sample.column("text").combine_chunks(), known))
    for _ in range(EPOCHS):
        for piece in found:
            trainer.learn(piece.target, *contexts(piece.target, piece.starts, piece.before_one, piece.before_two))
    return trainer


def trained(found: DataFrame, known: Vocabulary, begun: Trainer) -> Vectors:
    """The mean of what every task learns from all its documents, weighted by their tokens."""
    start = begun.vectors
    shared = found.sparkSession.sparkContext.broadcast((known, start, begun.squares))
    width = start.target.shape[1] + 1
    schema = "place int, weight double, vector array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start, squares = shared.value
        trainer = Trainer(known, start, squares=squares)
        for batch in batches:
            target, first, second, _ = stored_contexts(batch)
            trainer.learn(target, first, second)
        if trainer.seen:
            packed = trainer.vectors.packed()
            flat = pa.array((packed * trainer.seen).ravel())
            vector = pa.ListArray.from_arrays(pa.array(np.arange(len(packed) + 1) * width, pa.int32()), flat)
            weight = pa.array(np.full(len(packed), float(trainer.seen)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(packed)), pa.int32()), weight, vector], ["place", "weight", "vector"])

    learned = map_batches(found.filter("not held_out and codes is not null").select("codes", "first", "second"), run, schema)
    sums = [F.sum(F.col("vector")[i]).alias(f"v{i}") for i in range(width)]
    mean = learned.groupBy("place").agg(F.sum("weight").alias("weight"), *sums).toArrow()
    if not len(mean):
        return start
    out = np.zeros_like(start.packed())
    weight = mean.column("weight").to_numpy()
    out[mean.column("place").to_numpy()] = np.stack([mean.column(f"v{i}").to_numpy() / weight for i in range(width)], 1)
    return start.unpacked(out)


@dataclass
class Model:
    """Scores of targets by context, and the log of their sum for every pair of contexts."""

    known: Vocabulary
    vectors: Vectors
    norm: np.ndarray

    @staticmethod
    def of(known: Vocabulary, vectors: Vectors) -> "Model":
        first = vectors.first.astype(np.float64) @ vectors.target.T
        second = vectors.second.astype(np.float64) @ vectors.target.T + vectors.bias
        most = first.max(1), second.max(1)
        # The sum over targets of exp(a + b) is a product of two matrices of exponentials.
        sums = np.exp(first - most[0][:, None]) @ np.exp(second - most[1][:, None]).T
        norm = np.log(np.maximum(sums, 1e-300)) + most[0][:, None] + most[1]
        return Model(known, vectors, norm.astype(np.float32))

    def log_probability(self, target: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Natural log of each class after its two contexts; over all classes these add up to one."""
        v = self.vectors
        context = v.first[first] + v.second[second]
        return np.einsum("ij,ij->i", context, v.target[target]) + v.bias[target] - self.norm[first, second]


# The whole


def fit(rows: DataFrame, head: int = HEAD, own: int = OWN, tails: int = TAILS) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the stored texts as classes, and ``word, n_train`` of the tokens it does not hold itself."""
    counts = store(token_counts(rows), "tokens")
    known, rare = vocabulary(counts, head, own, tails)
    found = store(encoded(rows, known), "encoded")
    return Model.of(known, trained(found, known, started(rows, known))), found, rare


def class_scores(found: DataFrame, model: Model) -> DataFrame:
    """``row, doc_id, held_out, n_tokens, n_known, base, score`` of whole texts and pieces."""
    shared = found.sparkSession.sparkContext.broadcast(model)
    kept = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target, first, second, starts = stored_contexts(batch)
            logs = np.zeros(len(target) + 1)
            for start in range(0, len(target), STEP):
                piece = slice(start, start + STEP)
                logs[start + 1 : start + 1 + STEP] = shared.value.log_probability(target[piece], first[piece], second[piece])
            upto = np.cumsum(logs)
            sums = (upto[np.append(starts[1:], len(target))] - upto[starts]) / LN10 + batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[4:], pa.array(sums)], [*kept, "score"])

    rows = found.filter("codes is not null").select("codes", "first", "second", "within", *kept)
    return map_batches(rows, run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double")


def score_documents(docs: DataFrame, key="doc_id", text="text", head: int = HEAD, own: int = OWN, tails: int = TAILS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row."""
    small_batches(docs.sparkSession)
    rows = documents(docs, key, text)
    model, found, rare = fit(rows, head, own, tails)
    # A token with a count adds its log to both scores; one without adds log 1.
    words = found.filter("word is not null").select("row", "word", "times").join(rare, "word")
    log = F.col("times") * F.log10(F.col("n_train") + F.lit(1.0))
    more = words.groupBy("row").agg(F.sum("times").alias("n_known"), F.sum(log).alias("more"))
    whole = class_scores(found, model).withColumn("more", F.lit(0.0))
    fixed = [F.lit(None).cast(kind).alias(name) for name, kind in (("doc_id", "long"), ("held_out", "boolean"))]
    rest = more.select("row", *fixed, F.lit(0).cast("long").alias("n_tokens"), "n_known", *[F.lit(0.0).alias(c) for c in ("base", "score")], "more")
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score", "more")]
    summed = whole.unionByName(rest).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *sums)
    known = model.known
    each = F.lit(float(np.log10(known.total + known.distinct + 1.0)))
    return summed.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more") - F.col("n_tokens") * each).alias("base_score"), (F.col("score") + F.col("more")).alias("score"),
    )
