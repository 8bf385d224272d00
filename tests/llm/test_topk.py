"""Top-k search against scoring every row."""

import numpy as np
import pytest

from opinara.llm import topk


def brute_force(rows, k=5, every=50):
    whole = [
        (i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in sorted(whole):
        if i % every == 0:
            queries.setdefault(i, v)
    out = []
    for q, v in queries.items():
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shard_rows", [topk.SHARD_ROWS, 60])
def test_equals_all_scores(spark, small_dir, shard_rows):
    table = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    expected = brute_force([(r.vec_id, r.embedding) for r in table.collect()])
    assert result(topk.top_k(table, shard_rows=shard_rows)) == expected


def test_ties_copies_odd_rows(spark):
    rows = [(i, [0.5, -0.25, float(i % 3)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 1.0, 1.0]) for i in range(300)]  # one common vector
    rows += [(2000, None), (2050, []), (2100, [1.0, None, 0.0]), (2150, [float("nan"), 0.0, 1.0]), (2200, [float("inf"), 0.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (3000, [1.0, 2.0]), (3050, [3.0, 1.0]), (3100, [7.0]), (150, [0.5, -0.25, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as shard")
    assert result(topk.top_k(table, shard_rows=100)) == brute_force(rows)
    assert topk.top_k(table.limit(0)).count() == 0


def test_tree_prunes_and_is_exact():
    dice = np.random.default_rng(1)
    centers = dice.normal(0, 500, (8, 6))
    points = np.floor(centers[dice.integers(0, 8, 4000)] + dice.normal(0, 5, (4000, 6)))
    tree = topk.Tree(np.arange(4000), points, 50)
    leaves = [i for i, child in enumerate(tree.left) if child < 0]
    query = centers[0]
    bound = tree.bounds(query[None])[0]
    found = tree.search(query, -1, bound, 5, -np.inf)
    scores = sorted(((float(p @ query), -i) for i, p in enumerate(points)), reverse=True)[:5]
    assert [i for _, i in found] == [-i for _, i in scores]
    assert (bound[leaves] >= found[-1][0]).sum() < len(leaves) / 2


def test_large_components_take_part(spark):
    dice = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in dice.normal(0, 5, 3)]) for i in range(300)]
    rows += [(400, [2.0**20, 0.5, -1.0]), (401, [3e6, -2.0, 7.0]), (402, [-(2.0**21), 1.0, 1.0]), (450, [2.0**22, 2.5, 1.0])]
    expected = brute_force(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {q for q, *_ in expected} >= {400, 450} and all(abs(s) < 2**63 for *_, s in expected)
    for shard_rows in (topk.SHARD_ROWS, 60):
        assert result(topk.top_k(table, shard_rows=shard_rows)) == expected


@pytest.mark.parametrize("kind, power", [("float", 30), ("float", 100), ("double", 900), ("double", 1020)])
def test_scores_beyond_a_long_rank_exactly(spark, kind, power):
    dice = np.random.default_rng(power)
    rows = [(i, [float(x) * 2.0 ** (power * (i % 3 == 0) + 2) for x in dice.integers(-3, 4, 4)]) for i in range(200)]
    expected = [(q, r, i, s if abs(s) < 2**63 else None) for q, r, i, s in wide_brute_force(rows)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    assert any(s is None for *_, s in expected)
    for shard_rows in (topk.SHARD_ROWS, 40):
        assert sorted(map(tuple, topk.top_k(table, shard_rows=shard_rows).collect()), key=lambda r: r[:2]) == expected


def wide_brute_force(rows, k=5, every=50):
    whole = [(i, [int(x) * 256 for x in v]) for i, v in rows]
    scored = lambda i, v: sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)
    return [(i, rank, j, -s) for i, v in whole if i % every == 0 for rank, (s, j) in enumerate(scored(i, v)[:k], 1)]


def test_codes_are_ordered():
    numbers = sorted([*(s * (1 << p) + d for p in (0, 7, 8, 63, 64, 500, 4000) for s in (-1, 1) for d in (-1, 0, 1))])
    codes = [topk.encoded(n) for n in numbers]
    assert codes == sorted(codes) and [topk.decoded(c) for c in codes] == numbers
