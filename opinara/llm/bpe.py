"""Encoding and decoding with a byte-level BPE vocabulary with word ends.

A text is cut at the strings of the added tokens, normalised (NFC, lower case character by character)
and split into words. A word's bytes become symbols of a doubly
linked list; a priority queue holds the ranks of mergeable neighbours. The lowest rank merges first,
the leftmost among equals; entries whose symbols have changed since are stale and skipped. Every
distinct word is merged once per task as long as the bounded cache holds it. Decoding concatenates
the vocabulary strings of the ids, with a blank between tokens as the vocabulary file prescribes
when it names no decoder.

The vocabulary file (path a parameter) is read by the driver and broadcast: its size is that of the
file and does not grow with the data.

A null text counts as empty: no ids, an empty decoded text. Every row is treated by itself, so
repeated rows, null keys and other columns of any name make no difference.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from opinara.llm.frames import documents_of, map_batches

CACHE_WORDS, CACHED_LENGTH, PIECE_ROWS = 150_000, 64, 512
# White space as the Unicode property White_Space has it.
SPACE = r"\t-\r \x85\xa0  -     　"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS_SCHEMA = "doc_id long, ids array<int>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, extra = [], 0x100
    for byte in range(256):
        letters.append(chr(byte if byte in printable else extra))
        extra += byte not in printable
    return letters


class Vocabulary:
    """What a tokenizer file says: strings and ids, merge ranks, added tokens, the word pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
        # (left id, right id) -> (rank, merged id)
        self.merges = {}
        for rank, (left, right) in enumerate(pairs):
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.strings = {number: string for string, number in (self.ids | self.added).items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The Python engine's \s differs from White_Space in the control characters.
        self.pattern = pattern.replace(r"[^\s", f"[^{SPACE}")


class Codec:
    """Encodes and decodes with one vocabulary; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        letters = byte_letters()
        self.inner = [vocabulary.ids[c] for c in letters]
        self.last = [vocabulary.ids[c + vocabulary.end] for c in letters]
        self.words = regex.compile(vocabulary.pattern)
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        # Two generations: when the recent words fill it up, those not met since the last time go.
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.table = [vocabulary.strings.get(i, "") for i in range(max(vocabulary.strings) + 1)]

    def normalise(self, text: str) -> str:
        """White space is left as it is: no word of the pattern holds any, so its kind can't matter."""
        if text.isascii():
            return text.lower()
        # str.lower() looks at a sigma's neighbours; the vocabulary lowers each character by itself.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        parts = self.cut.split(text) if self.cut else [text]
        for number, part in enumerate(parts):
            if number % 2:
                ids.append(self.v.added[part])
                continue
            if not part:
                continue
            cache, add = self.cache, ids.extend
            for word in self.words.findall(self.normalise(part)):
                known = cache.get(word)
                add(self.encode_word(word) if known is None else known)
        return ids

    def encode_word(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            raw = word.encode("utf-8")
            ids = tuple(self.merge([self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]))
        if len(word) <= CACHED_LENGTH:
            if len(self.cache) >= CACHE_WORDS:
                self.older = self.cache.copy()
                self.cache.clear()  # the same object: encode() holds on to it
            self.cache[word] = ids
        return ids

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge in rank order over a doubly linked list; a removed symbol is -1."""
        count, merges = len(symbols), self.v.merges
        after = [*range(1, count), -1]
        before = [*range(-1, count - 1)]
        queue = []

        def offer(left: int, right: int) -> None:
            pair = (symbols[left], symbols[right])
            found = merges.get(pair)
            if found:
                heapq.heappush(queue, (found[0], left, pair, found[1]))

        for place in range(count - 1):
            offer(place, place + 1)
        while queue:
            _, left, pair, merged = heapq.heappop(queue)
            right = after[left]
            if right < 0 or (symbols[left], symbols[right]) != pair:
                continue  # stale
            symbols[left], symbols[right] = merged, -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [symbol for symbol in symbols if symbol >= 0]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.table.__getitem__, ids))


def _codecs(docs: DataFrame, path: str):
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    return lambda: Codec(shared.value)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` for every document."""
    codec_of = _codecs(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for batch in batches:
            ids = [codec.encode(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_batches(documents_of(docs, key, text), run, IDS_SCHEMA)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text``: the vocabulary strings of the ids. Null ids count as none."""
    codec_of = _codecs(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for batch in batches:
            texts = [codec.decode(value.as_py() or []) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.selectExpr(f"cast(`{key}` as long) doc_id", f"cast(`{ids}` as array<int>) ids")
    return map_batches(rows, run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token counts and digests of ids and decoded text, without moving either out of the task."""
    codec_of = _codecs(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for value in batch.column(1):
                ids = codec.encode(value.as_py())
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                text_digests.append(hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(documents_of(docs, key, text), run, DIGEST_SCHEMA)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: what a model would be fed, and what it stands for."""
    codec_of = _codecs(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for batch in batches:
            for start in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(start, PIECE_ROWS)
                ids = [codec.encode(value.as_py()) for value in piece.column(1)]
                columns = [
                    piece.column(0), pa.array(list(map(len, ids)), pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())), pa.array(list(map(codec.decode, ids)), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])

    return map_batches(documents_of(docs, key, text), run, "doc_id long, n_tokens long, ids array<int>, decoded string")
