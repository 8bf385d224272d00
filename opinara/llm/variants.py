"""Spelling variants: words one edit apart, and for each the more frequent form it stands for.

Words are runs of letters, of which Spark counts the distinct ones over all documents. A pair one edit
apart agrees in the first half or in the last half of either word. So a bidirectional FM-index over the
delimited vocabulary finds the places of each half exactly, from the middle outwards, and goes on over the
other half with one edit.

The index is built in shards. A word of ``m`` letters is stored by ``m`` with its first
``(m - 1) // 2`` letters for the search from the front, and with its last ``m // 2`` for the search from the back; a
query of ``n`` letters looks for words of ``n - 1``, ``n`` and ``n + 1``, so it meets every word it can be near to, and
few others. Shards are as many as the vocabulary asks for; one that holds too many words is cut into
parts, each of which meets all queries of the shard in blocks. Nothing is dropped for being frequent.

Links lead from each word to all its near words; a word's form is the most frequent of these, if it is
at least twice as frequent. Chains of forms at least double the count at each step, so following them
by doubling ends after few joins; what is joined are only the forms of forms, spread over salted keys.

Defined results: null and empty texts have no words; a null key counts as the text ``null`` where it decides
on deletions; repeated rows count as often as they occur; without words the result is empty. A word of
any length takes part, in time that grows with its length. Other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opinara.llm import tokens
from opinara.llm.fm_index import Index
from opinara.llm.frames import map_batches, ship, store, text_of

LEAST_LETTERS, LEAST_COUNT, TIMES, DELETED = 5, 3, 2, 97
SHARD_WORDS, SALTS = 8192, 16
# The bytes that begin the letters U+00C0 to U+00FF in UTF-8, and the CRC-32 polynomial.
LEAD, POLYNOMIAL = 0xC3, 0xEDB88320
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def letter_runs(piece: tokens.Piece) -> tokens.Spans:
    lead = piece.data == LEAD
    solid = ASCII_LETTER[piece.data] | lead
    solid[1:] |= lead[:-1]
    solid[len(solid) - tokens.WIDE :] = False
    return tokens.spans(piece, solid)


def crc32(data: np.ndarray, found: tokens.Spans, heads: np.ndarray) -> np.ndarray:
    """Of each span behind the text whose CRC-32 is in ``heads``, one byte of all spans at a time."""
    state = heads[found.row] ^ np.uint32(0xFFFFFFFF)
    live, size, step = np.arange(len(state)), found.ends - found.starts, 0
    while len(live):
        state[live] = CRC[(state[live] ^ data[found.starts[live] + step]) & 255] ^ (state[live] >> np.uint32(8))
        step += 1
        live = live[size[live] > step]
    return state ^ np.uint32(0xFFFFFFFF)


def counted_words(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """``word, n`` of the words with enough letters and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = tokens.Tally()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            heads = np.array([zlib.crc32(f"{'null' if i is None else i}:".encode()) for i in ids], np.uint32)
            for piece in tokens.pieces(batch.column(1)):
                for full in _words(piece, heads, tally):
                    yield pa.RecordBatch.from_arrays(full, ["word", "n"])
        for full in tally.drain():
            yield pa.RecordBatch.from_arrays(full, ["word", "n"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"))
    counted = map_batches(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _words(piece: tokens.Piece, heads: np.ndarray, tally: tokens.Tally) -> Iterator[list[pa.Array]]:
    found = letter_runs(piece)
    hashes = crc32(piece.data, found, heads[piece.first : piece.first + len(piece)])
    letters = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum(piece.data & 0xC0 != 0x80, out=letters[1:])  # bytes that begin a code point
    size = letters[found.ends] - letters[found.starts]
    cut = hashes % DELETED == 0
    whole = ~cut & (size >= LEAST_LETTERS)
    yield from tally.add(piece.data, found.starts[whole], found.ends[whole], [np.ones(int(whole.sum()), np.int64)])
    short = []
    for i in np.flatnonzero(cut & (size > LEAST_LETTERS)):
        word = piece.data[found.starts[i] : found.ends[i]].tobytes().decode()
        place = int(hashes[i]) % len(word)
        short.append((word[:place] + word[place + 1 :]).encode())
    data = np.frombuffer(b"".join(short) + bytes(tokens.WIDE), np.uint8).copy()
    ends = np.cumsum(list(map(len, short)), dtype=np.int64)
    yield from tally.add(data, np.concatenate([[0], ends[:-1]]) if short else ends, ends, [np.ones(len(short), np.int64)])


# Near words


def _bucket(front: bool, word, size, shards: int):
    """Where words of ``size`` letters are stored that share half of theirs with ``word``."""
    half = F.left(word, F.floor((size - 1) / 2).cast("int")) if front else F.right(word, F.floor(size / 2).cast("int"))
    return F.pmod(F.xxhash64(F.lit(front), size, half), F.lit(shards)).cast("int")


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, near, near_n``: every pair one edit apart, in both directions. ``words`` is a stored ``word, n``."""
    shards = max(-(-words.count() // shard_words), 1)
    size = F.length("word")
    stored, asked = [], []
    for front in (True, False):
        stored.append(words.select(F.lit(front).alias("front"), _bucket(front, F.col("word"), size, shards).alias("shard"), "word", "n"))
        places = F.array_distinct(F.array(*[_bucket(front, F.col("word"), size + more, shards) for more in (-1, 0, 1)]))
        asked.append(words.select(F.lit(front).alias("front"), F.explode(places).alias("shard"), "word"))
    stored, asked = stored[0].unionByName(stored[1]), asked[0].unionByName(asked[1])
    # One row a shard; what is too large becomes parts, each with all the queries in as many blocks.
    held = stored.groupBy("front", "shard").agg(F.count(F.lit(1)).alias("held"))
    held = held.select("front", "shard", F.ceil(F.col("held") / (2 * shard_words)).cast("int").alias("parts"))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(held, ["front", "shard"])
        mine = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias(own)
        return rows.select("*", mine, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias(other)).drop("parts")

    group = ["front", "shard", "part", "block"]
    stored, asked = dealt(stored, "part", "block"), dealt(asked, "block", "part")
    # Both sides come from one table; under new names they are told apart.
    stored, asked = stored.toDF(*stored.columns), asked.toDF(*asked.columns)
    ship(words.sparkSession)
    return asked.groupBy(*group).cogroup(stored.groupBy(*group)).applyInArrow(_near, "word string, near string, near_n long")


def _near(asked: pa.Table, stored: pa.Table) -> pa.Table:
    names = ["word", "near", "near_n"]
    if not asked.num_rows or not stored.num_rows:
        return pa.table([pa.array([], pa.string())] * 2 + [pa.array([], pa.int64())], names)
    front = stored.column("front")[0].as_py()
    stored = stored.select(["word", "n"]).sort_by("word")  # bytes of UTF-8 sort as code points
    words = asked.column("word").to_pylist()
    known = stored.column("word").to_pylist()
    query, found = Index(known).one_edit(words, front)
    if not front:
        # Those that agree in the first half as well are found from the front.
        new = [not known[f].startswith(words[q][: len(words[q]) // 2]) for q, f in zip(query.tolist(), found.tolist())]
        query, found = query[new], found[new]
    taken = stored.take(pa.array(found))
    columns = [asked.column("word").take(pa.array(query)), taken.column("word"), taken.column("n")]
    return pa.table(columns, names)


# Forms


def roots(forms: DataFrame) -> DataFrame:
    """Add ``root`` to ``word, form``: where following forms ends."""
    rows = store(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")
    while True:
        # Only roots that lead further matter; there are as many as words that have both a form and a variant.
        heads = rows.select("root").distinct().join(rows.filter("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next")), "root")
        heads = store(heads, "heads")
        if heads.isEmpty():
            return rows
        spread = heads.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        rows = rows.withColumn("salt", salt).join(spread, ["root", "salt"], "left")
        rows = store(rows.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variant_groups(docs: DataFrame, key="doc_id", text="text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word."""
    words = store(counted_words(docs, key, text), "words")
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))
    links = near_words(words, shard_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(best).alias("best"))
    strong = -F.col("best.less") >= TIMES * F.col("n")
    forms = words.join(links, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
    )
    forms = store(forms, "forms")
    return forms.join(roots(forms), "word")
