"""The manifest against trees built node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from opinara.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def join_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return join_hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([join_hash(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        other = level[i ^ 1] if i ^ 1 < len(level) else ""
        yield (other, "") if i % 2 else ("", other)
        i //= 2


def brute_force(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf_of(row)))
        trees[lang] = levels_over([leaf_of(row) for row in by_lang[lang]])
    top = levels_over([trees[lang][-1][0] for lang in langs])
    for number, lang in enumerate(langs):
        for i, row in enumerate(by_lang[lang]):
            path = [*steps(trees[lang], i), *steps(top, number)]
            shown = row
            if None not in (row[0], row[3]) and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                shown = (*row[:3], row[3] + 1, row[4])
            node = leaf_of(shown)
            for before, after in path:
                node = join_hash(before, node, after)
            proof = join_hash(*[before + after for before, after in path])
            yield row[0], leaf_of(row), trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: tuple((v is not None, v) for v in row))


def odd_rows(count):
    """Null and shared keys, null fields and languages, empty and long texts, exact repeats."""
    langs = ["en", "fr", None, "é", ""]
    return [
        (i % 150 if i % 11 else None, "s" if i % 3 else None, langs[i * i % 5], i % 40 if i % 4 else None, "" if i % 13 == 0 else "tü" * (i % 40))
        for i in range(count)
    ]


TABLES = {
    "odd": odd_rows(300),
    "one": [(5, "s", "en", 1, "a")],
    "two": [(5, "s", "en", 1, "a"), (4, "s", "fr", 1, "a")],
    "none": [],
    "one_key": [(9, None, None, 3, None)] * 130,
    "block_edges": [(i, "s", "en", i, "t") for i in range(65)] + [(i, "s", "de", i, "t") for i in range(64)],
    "long": [(1, "s", "en", 1, "x" * (1 << 21)), (2, "s", "en", 2, "")],
}


@pytest.mark.parametrize("name", TABLES)
def test_equals_trees_built_node_by_node(spark, name):
    rows = TABLES[name]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    # Other columns may be called whatever the operator's own are called.
    docs = docs.withColumns({c: F.lit("x") for c in ("tree", "leaf", "lo", "n", "digest", "block", "path", "root", "top")})
    assert ordered(merkle.manifest(docs).select(*COLUMNS).collect()) == ordered(brute_force(rows))


def test_paths_hold_the_siblings_of_every_level(spark):
    rows = [(i, "s", "en", i, "t") for i in range(70)] + [(i, "s", "fr", i, "t") for i in range(3)]
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).filter("lang = 'en'").collect()
    tree = levels_over([leaf_of(row) for row in rows[:70]])
    top = levels_over([tree[-1][0], levels_over([leaf_of(row) for row in rows[70:]])[-1][0]])
    assert len(tree) == 8
    for row in found:
        assert [(s.before, s.after) for s in row.path] == [*steps(tree, row.doc_id), *steps(top, 0)]


def test_any_order_and_partitioning_gives_one_root(spark):
    docs = spark.createDataFrame(odd_rows(200), SCHEMA)
    roots = {merkle.manifest(docs.repartition(n).orderBy(F.rand(n))).first().root for n in (1, 7)}
    assert len(roots) == 1


def test_no_block_outgrows_its_band(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, "t") for i in range(1000)], SCHEMA)
    bands = merkle.planted(merkle.leaves(docs), ["doc_id", "leaf", "ordinal"], "leaf")
    assert len(bands) == 2
    for members, _, _ in bands:
        assert members.groupBy("tree", "block").count().agg(F.max("count")).first()[0] <= 1 << merkle.BAND
