"""The codec against the library, on documents and on random characters; decoding as a round trip."""

import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from opinara.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary(PATH))


def test_random_characters(library, codec):
    dice = random.Random(1)
    pool = [*range(0x250), *range(0x300, 0x340), *range(0x390, 0x3D0), 0x85, 0xA0, 0x200B, 0x2028, 0x3000, 0xFEFF, 0x1F600, 0x4E00, 0x661, 0x2460, 0x130, 0x1C5, 0x1E9E, 0xAC00, 0x1100, 0x1161, 0xFB01, 0x212B, 0x1D7CE, 0x10400]
    for _ in range(10_000):
        text = "".join(chr(dice.choice(pool)) for _ in range(dice.randint(0, 25)))
        if dice.random() < 0.2:
            text += dice.choice(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext|"]) + text
        ids = codec.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words(library, codec):
    for text in ("a" * 20_000, "the" * 5000, "!" * 5000, "ab1" * 3000):
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_small_cache_changes_nothing(library, monkeypatch, codec):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    small = bpe.Codec(codec.v)
    text = "one two three four one two three four five six one " * 20
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_digests_on_documents(spark, small_dir, library):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    found = {r.doc_id: r for r in bpe.round_trip_digests(docs, PATH).collect()}
    for row in docs.collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        mine = found[row.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert mine.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_decode_and_odd_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (None, "Hello world", None), (3, " \n\t", "z"), (4, "Hello world", "z"), (4, "Hello world", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, PATH)
    assert sorted(len(r.ids) for r in encoded.collect()) == [0, 0, 0, 2, 2, 2]
    decoded = sorted(r.text for r in bpe.decode(encoded, PATH).collect())
    assert decoded == ["", "", "", *["hello</w> world</w>"] * 3]
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0
    assert {r.decoded for r in bpe.round_trip(docs, PATH).collect()} == {"", "hello</w> world</w>"}
