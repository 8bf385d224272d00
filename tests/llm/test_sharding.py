"""Extendible hashing: every shard fits, splits are only made where needed, and hot keys overflow."""

import hashlib
from collections import defaultdict

import pytest

from opinara.llm import sharding


def bits_of(key):
    name = "null" if key is None else str(key)
    return bin(int(hashlib.md5(name.encode()).hexdigest()[:15], 16))[2:].zfill(60)


def brute_force(rows, limit):
    """Key to prefix: split while a bucket is over the limit."""
    def split(part, prefix):
        if sum(size for _, size in part) <= limit or len(prefix) == 60:
            return {(key, prefix) for key, _ in part}
        out = set()
        for bit in "01":
            out |= split([r for r in part if bits_of(r[0])[len(prefix)] == bit], prefix + bit)
        return out
    return split(rows, "")


@pytest.mark.parametrize("limit", [300, 5_000, 100_000, 10_000_000])
def test_prefixes_equal_splitting_by_hand(spark, small_dir, limit):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r.doc_id, len(r.text.encode())) for r in docs.collect() if len(r.text.encode()) <= limit]
    docs = docs.filter(f"octet_length(text) <= {limit}")
    found = sharding.assign_shards(docs, limit=limit).collect()
    assert {(r.doc_id, r.shard) for r in found} == brute_force(rows, limit)
    assert all(len(r.shard) == r.depth and r.page == 0 for r in found)
    sizes = defaultdict(int)
    for r in found:
        sizes[r.shard] += r.bytes
    assert max(sizes.values()) <= limit


def test_hot_keys_overflow_into_pages(spark):
    rows = [(i, "x" * (i % 90)) for i in range(300)]
    rows += [(7, "y" * (20 + i % 60)) for i in range(400)] + [(None, "z" * 50)] * 200 + [(7, "w" * 900), (8, "v" * 2000), (9, None)]
    docs = spark.createDataFrame([(*r, "p") for r in rows], "doc_id long, text string, page string").repartition(5)
    found = sharding.assign_shards(docs, limit=1000, with_row=True).collect()
    assert sorted(map(str, ((r.row.doc_id, r.row.text) for r in found))) == sorted(map(str, rows))
    sizes, members = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.shard, r.page] += r.bytes
        members[r.shard, r.page] += 1
    assert all(size <= 1000 or members[place] == 1 for place, size in sizes.items())
    assert len({r.page for r in found if r.doc_id == 7}) < 60


def test_empty_table(spark):
    assert sharding.assign_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
