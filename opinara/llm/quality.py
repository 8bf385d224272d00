"""Quality rules: counted base rules, then bands of n-gram perplexity for each language.

The language model is a modified Kneser-Ney model over the characters of words, with marks for the
begin and end of a word, for each value of the language column. Spark counts it over all documents:
words by language first, combined per task, then the n-grams of distinct words with the words' counts.
Continuation counts, counts of counts and the sums of each context are aggregations of those.

An n-gram is known by its order and 60 bits of a hash, language included, so different n-grams are not
added up, and the model grows with the corpus. Up to ``MODEL_ENTRIES`` counts and contexts it is broadcast as
sorted arrays of such hashes with their values, looked up by bisection; each task scores a distinct word
once as long as its bounded cache holds it. A larger model stays a table: the probability of each n-gram,
then of each word, then of each document, are joins.

A language's band is the median of the log perplexity of all its documents that pass the base rules,
give or take ``WIDTH`` times the median distance from it, widened by ``SHORT / sqrt(characters)``,
since the mean over few characters strays further. Medians come from counts of hundredths. A document
outside the band on either side is rejected: above is noise, below is repetition.

Defined results: a null text has no words and fails the base rules; a null language is a language of its
own; rows are treated by themselves but for the counts, where repeated rows count as often as they
occur; null keys are kept; an empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from opinara.llm import kernels, tokens
from opinara.llm.frames import map_batches, materialize, store, text_of

ORDER, SLOT_BITS = 4, 60
MODEL_ENTRIES = 1 << 21
WIDTH, SHORT, LEAST_WIDTH, BINS = 6.0, 2.0, 0.08, 100
COUNTED_WORDS, CACHED_WORDS, PIECE_ROWS, MAX_LANGUAGES = 200_000, 800_000, 500, 4096
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = [bytes([symbol]) for symbol in b"#*$%&|<>"]
NO_LANGUAGE = "\0"


def documents_by_language(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    language = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE))
    return docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"), language.alias("lang"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n`` over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, tokens.Tally] = {}

        def named(lang: str, full: Iterator) -> Iterator[pa.RecordBatch]:
            for words, n in full:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), words, n], ["lang", "word", "n"])

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for piece in tokens.pieces(batch.column(0), lower=False):
                found = tokens.spans(piece, tokens.blank_free(piece.data))
                names, which = np.unique(langs[piece.first : piece.first + len(piece)], return_inverse=True)
                own = which[found.row]
                for place, lang in enumerate(names):
                    at = own == place
                    tally = tallies.setdefault(lang, tokens.Tally())
                    yield from named(lang, tally.add(piece.data, found.starts[at], found.ends[at], [np.ones(int(at.sum()), np.int64)]))
                if sum(tally.held for tally in tallies.values()) > COUNTED_WORDS:
                    for lang, tally in tallies.items():
                        yield from named(lang, tally.drain())
        for lang, tally in tallies.items():
            yield from named(lang, tally.drain())

    counted = map_batches(docs.select("text", "lang"), run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def language_hash(langs: list[str]) -> np.ndarray:
    """A hash of each language's name, the same in every process."""
    names = {lang: int.from_bytes(lang.encode("utf-8", "surrogatepass")[:64], "little") % (1 << 61) for lang in set(langs)}
    return kernels.mix(np.array([names[lang] for lang in langs], np.uint64) + np.uint64(1))


def slots(hashes: np.ndarray, n: int, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) | (n << bits)


def gram_counts(words: DataFrame, order: int, bits: int) -> DataFrame:
    """``n, gram, slot, context, shorter, opens, count``: distinct n-grams; opens: begins with the mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, names, counts = (batch.column(i) for i in range(3))
            found = kernels.word_grams(names.to_pylist(), language_hash(langs.to_pylist()), order)
            weight = counts.to_numpy()[found.owner]
            for n in range(1, order + 1):
                at = np.flatnonzero(found.step >= max(n - 1, 1))
                gram, first, inverse = np.unique(found.hashes[n][at], return_index=True, return_inverse=True)
                total = np.bincount(inverse, weight[at], len(gram)).astype(np.int64)
                one = at[first]
                columns = [
                    np.full(len(gram), n, np.int32), kernels.signed(gram), slots(gram, n, bits),
                    slots(found.hashes[n - 1][one - 1] if n > 1 else found.hashes[0][one], n - 1, bits),
                    slots(found.hashes[n - 1][one], n - 1, bits), found.step[one] == n - 1, total,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["n", "gram", "slot", "context", "shorter", "opens", "count"])

    schema = "n int, gram long, slot long, context long, shorter long, opens boolean, count long"
    grams = map_batches(words, run, schema)
    alike = [F.first(c).alias(c) for c in ("slot", "context", "shorter", "opens")]
    return grams.groupBy("n", "gram").agg(*alike, F.sum("count").alias("count"))


@dataclass
class Model:
    """Sorted slots with adjusted counts; sorted contexts with sums and weights left to shorter ones."""

    order: int
    bits: int
    slots: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    sums: np.ndarray
    left: np.ndarray
    discounts: np.ndarray  # by order and min(count, 3)
    base: float

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0)

    def log_probability(self, words: list[str], lang: str) -> np.ndarray:
        """Natural log probability of each word, its end mark included."""
        if not len(self.slots):
            return np.zeros(len(words))
        found = kernels.word_grams(words, np.repeat(language_hash([lang]), len(words)), self.order)
        p = np.full(len(found.step), self.base)
        for n in range(1, self.order + 1):
            at = np.flatnonzero(found.step >= max(n - 1, 1))
            context = slots(found.hashes[n - 1][at - 1] if n > 1 else found.hashes[0][at], n - 1, self.bits)
            total = self._find(self.contexts, self.sums, context)
            known = total > 0
            at, context, total = at[known], context[known], total[known]
            count = self._find(self.slots, self.counts, slots(found.hashes[n][at], n, self.bits))
            kept = np.maximum(count - self.discounts[n][np.minimum(count, 3).astype(np.int64)], 0) / total
            p[at] = kept + self._find(self.contexts, self.left, context) * p[at]
        logs = np.log(np.clip(p, 1e-12, 1.0))
        logs[found.step == 0] = 0
        return np.bincount(found.owner, logs, len(words))


@dataclass
class Counts:
    """The model as tables: ``n, slot, a`` and ``n, context, sum, n1, n2, n3``; the n-grams they come from."""

    order: int
    bits: int
    grams: DataFrame
    adjusted: DataFrame
    contexts: DataFrame
    discounts: np.ndarray
    letters: int

    def entries(self) -> int:
        return self.adjusted.count() + self.contexts.count()

    def model(self) -> Model:
        """All of it on the driver."""
        counts = self.adjusted.select("slot", "a").toArrow().to_pandas().sort_values("slot")
        known = self.contexts.toArrow().to_pandas().sort_values("context")
        sums = known["sum"].to_numpy(np.float64)
        own = self.discounts[known["n"].to_numpy(np.int64)]
        left = sum(own[:, k] * known[f"n{k}"].to_numpy() for k in (1, 2, 3)) / np.maximum(sums, 1)
        return Model(
            self.order, self.bits, counts["slot"].to_numpy(np.int64), counts["a"].to_numpy(np.float64),
            known["context"].to_numpy(np.int64), sums, left, self.discounts, 1.0 / (self.letters + 1),
        )


def count(docs: DataFrame, order: int = ORDER, bits: int = SLOT_BITS) -> Counts:
    """Count the model over ``doc_id, text, lang``."""
    grams = materialize(gram_counts(word_counts(docs), order, bits))
    whole = grams.filter((F.col("n") == order) | F.col("opens")).select("n", "slot", F.col("count").alias("a"))
    continued = grams.filter("n > 1").select((F.col("n") - 1).alias("n"), F.col("shorter").alias("slot"), F.lit(1).alias("a"))
    adjusted = materialize(whole.unionByName(continued).groupBy("n", "slot").agg(F.sum("a").alias("a")))
    pairs = grams.select("n", "slot", "context").distinct().join(adjusted, ["n", "slot"])
    times = [F.count(F.when(F.col("a") == k, 1)).alias(f"n{k}") for k in (1, 2)]
    contexts = pairs.groupBy("n", "context").agg(F.sum("a").alias("sum"), *times, F.count(F.when(F.col("a") > 2, 1)).alias("n3"))
    of_counts = {row.n: row for row in adjusted.groupBy("n").agg(F.count(F.lit(1)).alias("all"), *[F.count(F.when(F.col("a") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).collect()}
    discounts = np.zeros((order + 1, 4))
    for n, row in of_counts.items():
        discounts[n] = _discounts([row.n1, row.n2, row.n3, row.n4])
    return Counts(order, bits, grams, adjusted, materialize(contexts), discounts, of_counts[1].all if 1 in of_counts else 0)


def fit(docs: DataFrame, order: int = ORDER, bits: int = SLOT_BITS) -> Model:
    """The model as arrays; for tables whose n-grams fit the driver."""
    return count(docs, order, bits).model()


def gram_scores(counts: Counts) -> DataFrame:
    """``slot, log_p`` of every n-gram that a place of a word is scored by: the longest that ends there."""
    shorter, found = None, []
    for n in range(1, counts.order + 1):
        own = counts.discounts[n].tolist()
        cut = F.when(F.col("a") > 2, own[3]).when(F.col("a") == 2, own[2]).when(F.col("a") == 1, own[1]).otherwise(own[0])
        kept = F.greatest(F.col("a") - cut, F.lit(0.0)) / F.col("sum")
        left = sum((F.col(f"n{k}") * own[k] for k in (1, 2, 3)), F.lit(0.0)) / F.col("sum")
        level = counts.grams.filter(F.col("n") == n).select("slot", "context", "shorter", "opens").dropDuplicates(["slot"])
        level = level.join(counts.adjusted.filter(F.col("n") == n).select("slot", "a"), "slot")
        level = level.join(counts.contexts.filter(F.col("n") == n).drop("n"), "context")
        below = F.lit(1.0 / (counts.letters + 1))
        if shorter is not None:
            level = level.join(shorter.select(F.col("slot").alias("shorter"), F.col("p").alias("below")), "shorter")
            below = F.col("below")
        shorter = materialize(level.select("slot", "opens", (kept + left * below).alias("p")))
        found.append(shorter if n == counts.order else shorter.filter("opens"))
    scores = found[0]
    for level in found[1:]:
        scores = scores.union(level)
    return scores.select("slot", F.log(F.least(F.greatest("p", F.lit(1e-12)), F.lit(1.0))).alias("log_p"))


def word_scores(words: DataFrame, counts: Counts) -> DataFrame:
    """``lang, word, score``: what :meth:`Model.log_probability` gives, by joins."""
    order, bits = counts.order, counts.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = kernels.word_grams(names, language_hash(langs), order)
            longest = np.minimum(found.step + 1, order)
            slot = np.zeros(len(longest), np.int64)
            for n in range(1, order + 1):
                at = longest == n
                slot[at] = slots(found.hashes[n][at], n, bits)
            inner = found.step > 0
            ends = np.concatenate([[0], np.cumsum(np.bincount(found.owner[inner], minlength=len(names)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(slot[inner]))], ["lang", "word", "slots"])

    places = map_batches(words.select("lang", "word"), run, "lang string, word string, slots array<long>")
    places = places.select("lang", "word", F.explode("slots").alias("slot"))
    return places.join(gram_scores(counts), "slot").groupBy("lang", "word").agg(F.sum("log_p").alias("score"))


def _discounts(n: list[int]) -> list[float]:
    """Discounts for counts of 1, 2 and 3 or more, after Chen and Goodman; 0.5, 1, 1.5 where too few."""
    if min(n) == 0:
        return [0.0, 0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [0.0, *(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))]


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """``word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    return byte_counts(text.encode(), [word.encode() for word in words], len(text))


def byte_counts(text: bytes, words: list[bytes], chars: int) -> tuple[int, int, int, int]:
    """The same of a text of ``chars`` code points in UTF-8; blanks are single bytes."""
    seen: set[bytes] = set()
    doubled = 0
    for line in text.split(b"\n"):
        if line in seen:
            doubled += 1
        elif not line.isspace() and line:
            seen.add(line)
    blanks = len(text) - sum(map(len, words))
    return chars - blanks, sum(map(text.count, SYMBOLS)), doubled, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that the text holds twice or more, the first time included."""
    if len(words) <= WINDOW:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = kernels.grams(kernels.mix(hashes), WINDOW)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    again = np.isin(windows, twice)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(again)] += again
    edges[WINDOW : WINDOW + len(again)] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


MEASURED = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"


def _learn(known: dict[str, dict[bytes, float]], words: list[list[bytes]], langs: list[str], model: Model) -> None:
    """Score the words of some documents that are not known yet, all of a language at once."""
    if sum(map(len, known.values())) > CACHED_WORDS:
        known.clear()
    for lang in set(langs):
        scores = known.setdefault(lang, {})
        new = list(set().union(*(w for w, own in zip(words, langs) if own == lang)) - scores.keys())
        if new:
            scores.update(zip(new, model.log_probability([word.decode() for word in new], lang).tolist()))


def measured(docs: DataFrame, model: Model) -> DataFrame:
    """Base counts and mean negative log probability per character; null without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[bytes, float]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(start, PIECE_ROWS)
                texts, langs = piece.column(1).cast(pa.binary()).to_pylist(), piece.column(2).to_pylist()
                lengths = pc.utf8_length(piece.column(1)).to_pylist()
                words = [text.split() for text in texts]  # of bytes, only the blanks of ``WORD`` part words
                _learn(known, words, langs, shared.value)
                out = []
                for text, length, lang, found in zip(texts, lengths, langs, words):
                    counts = byte_counts(text, found, length)
                    total = sum(map(known[lang].__getitem__, found))
                    out.append((len(found), *counts, -total / (counts[0] + len(found)) if found else None))
                kinds = [*[pa.int64()] * 5, pa.float64()]
                columns = [piece.column(0), piece.column(2), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MEASURED.split(", ")])

    return map_batches(docs, run, MEASURED)


def measured_by_joins(docs: DataFrame, counts: Counts) -> DataFrame:
    """Like :func:`measured`, for a model that is too large for a broadcast."""
    names = [c.split()[0] for c in MEASURED.split(", ")][:-1]
    schema = "row long, " + MEASURED.rsplit(", ", 1)[0] + ", words array<string>, times array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(start, PIECE_ROWS)
                out, held = [], []
                for text in piece.column(1).to_pylist():
                    words = WORD.findall(text)
                    out.append((len(words), *base_counts(text, words)))
                    held.append(Counter(words))
                columns = [piece.column(0), piece.column(2), *(pa.array(c, pa.int64()) for c in zip(*out))]
                lists = [pa.array([list(h) for h in held], pa.list_(pa.string())), pa.array([list(h.values()) for h in held], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(out))), *columns, *lists], ["row", *names, "words", "times"])
                row += len(out)

    rows = store(map_batches(docs, run, schema), "words")  # the numbers of rows hold in one run only
    each = rows.select("row", "lang", F.inline(F.arrays_zip(F.col("words").alias("word"), "times")))
    each = each.join(word_scores(word_counts(docs), counts), ["lang", "word"])
    totals = each.groupBy("row").agg(F.sum(F.col("score") * F.col("times")).alias("total"))
    mean = -F.col("total") / (F.col("word_chars") + F.col("n_words"))
    return rows.drop("words", "times").join(totals, "row", "left").select(*names, mean.alias("log_perplexity"))


def median_bin(counts: DataFrame, value: str) -> DataFrame:
    """``lang`` and the median of ``value`` (whole numbers) weighted by ``n``; few distinct values each."""
    running = Window.partitionBy("lang").orderBy(value)
    total = F.sum("n").over(Window.partitionBy("lang"))
    ranked = counts.withColumn("upto", F.sum("n").over(running)).withColumn("total", total)
    return ranked.filter(F.col("upto") * 2 >= F.col("total")).groupBy("lang").agg(F.min(value).alias(value))


def bands(scored: DataFrame, width: float = WIDTH) -> DataFrame:
    """``lang, middle, reach`` from the documents that pass the base rules."""
    bin_ = F.floor(F.col("log_perplexity") * BINS)
    counts = scored.filter(~F.col("base_failed")).groupBy("lang", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    middle = median_bin(counts, "bin").withColumnRenamed("bin", "middle")
    away = counts.join(middle, "lang").select("lang", "middle", F.abs(F.col("bin") - F.col("middle")).alias("away"), "n")
    reach = median_bin(away.groupBy("lang", "away").agg(F.sum("n").alias("n")), "away")
    spread = F.greatest((F.col("away") + 0.5) / BINS * width, F.lit(LEAST_WIDTH))
    return middle.join(reach, "lang").select("lang", ((F.col("middle") + 0.5) / BINS).alias("middle"), spread.alias("reach"))


def apply_rules(
    docs: DataFrame, key="doc_id", text="text", lang="lang", order: int = ORDER, width: float = WIDTH, short: float = SHORT
) -> DataFrame:
    """One row per document: base counts, ``base_failed, kept, log_perplexity, low, high``."""
    rows = documents_by_language(docs, key, text, lang)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    counts = count(rows, order)
    scored = measured(rows, counts.model()) if counts.entries() <= MODEL_ENTRIES else measured_by_joins(rows, counts)
    scored = materialize(scored.withColumn("base_failed", failed))
    limits = materialize(bands(scored, width).withColumnRenamed("lang", "of"))
    if limits.count() <= MAX_LANGUAGES:  # a row per language; documents of one language are too many for a task
        limits = F.broadcast(limits)
    found = scored.join(limits, F.col("lang") == F.col("of"), "left")
    slack = F.col("reach") + short / F.sqrt(F.greatest(F.col("word_chars") + F.col("n_words"), F.lit(1)))
    inside = F.abs(F.col("log_perplexity") - F.col("middle")) <= slack
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce(~F.col("base_failed") & inside, F.lit(False)).alias("kept"), "log_perplexity",
        (F.col("middle") - slack).alias("low"), (F.col("middle") + slack).alias("high"),
    )
