"""Tokens, their keys and counts against splitting text by text."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from opinara.llm import tokens

DICE = random.Random(1)
TEXTS = ["".join(DICE.choices("aB é\n\tÀ÷", k=DICE.randint(0, 60))) for _ in range(400)] + ["", "x" * 100, " " * 30, "", "y z " * 50]


@pytest.mark.parametrize("limit", [8, 64, 1 << 20])
@pytest.mark.parametrize("texts", [TEXTS, [], [""], ["", "a"]])
def test_spans_of_pieces_are_the_words_of_texts(texts, limit):
    found, ended = [[] for _ in texts], 0
    for piece in tokens.pieces(pa.array(texts, pa.string()), limit):
        spans = tokens.spans(piece, tokens.blank_free(piece.data))
        for start, end, row in zip(spans.starts, spans.ends, spans.row):
            found[piece.first + row].append(piece.data[start:end].tobytes())
        ended += piece.ended
    assert found == [text.encode().lower().split() for text in texts]
    assert ended == len(texts)


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
def test_tally_counts_every_token_once(limit):
    counts, tally = Counter(), tokens.Tally(limit)

    def take(full):
        for words, n in full:
            for word, times in zip(words.to_pylist(), n.to_pylist()):
                counts[word] += times

    for piece in tokens.pieces(pa.array(TEXTS), 100):
        spans = tokens.spans(piece, tokens.blank_free(piece.data))
        take(tally.add(piece.data, spans.starts, spans.ends, [np.ones(len(spans.starts), np.int64)]))
    take(tally.drain())
    assert counts == Counter(word.decode() for text in TEXTS for word in text.encode().lower().split())


def test_keys_tell_long_words_of_like_structure_apart():
    """Words that polynomial hashes modulo 2^64 confuse, and words that differ in one byte anywhere."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    words = ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    words += ["c" * i + "d" + "c" * (40 - i) for i in range(41)] + ["c" * i for i in range(1, 40)]
    data = np.frombuffer("".join(words).encode() + bytes(tokens.WIDE), np.uint8).copy()
    ends = np.cumsum(list(map(len, words)))
    keys = tokens.keys(data, np.concatenate([[0], ends[:-1]]), ends)
    assert len(set(keys.tolist())) == len(words)
