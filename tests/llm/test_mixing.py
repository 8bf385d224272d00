"""The Pfair mix: windows, deviation, and rows out of the ordinary."""

import math
from collections import Counter
from fractions import Fraction

import pytest

from opinara.llm import mixing


def schedule(spark, parts):
    rows = [(f"s{i:02}", 1, part) for i, part in enumerate(parts)]
    plan = mixing.period_schedule(spark.createDataFrame(rows, "source string, n_rows long, part long")).first()
    return plan.runs


@pytest.mark.parametrize("parts", [[1], [1, 1], [5, 3, 2], [7, 1, 1, 1], [333, 333, 334], [1] * 30, [500, 250, 125, 60, 40, 20, 4, 1]])
def test_every_block_runs_in_its_window(spark, parts):
    period, runs = sum(parts), schedule(spark, parts)
    done = Counter()
    assert len(runs) == period
    for slot, index in enumerate(runs):
        k = done[index]
        assert math.floor(Fraction(k * period, parts[index])) <= slot < math.ceil(Fraction((k + 1) * period, parts[index]))
        done[index] += 1
        for i, part in enumerate(parts):
            assert abs(done[i] - Fraction(part * (slot + 1), period)) < 1
    assert [done[i] for i in range(len(parts))] == parts


def test_output_deviates_by_less_than_a_block(spark):
    rows = [(i, "big" if i % 3 else ("mid" if i % 2 else None)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = spark.createDataFrame([("big", 0.5), ("mid", 0.3), (None, 0.2), ("absent", 3.0)], "source string, weight double")
    found = sorted(mixing.mix(docs, weights, parts=100, block_rows=8).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(4000)) and {r.doc_id for r in found} == set(range(4000))
    totals, done = Counter(s for _, s in rows), Counter()
    for at, row in enumerate(found, 1):
        done[row.source] += 1
        if max(done[s] - totals[s] for s in totals) == 0:
            break  # a source has run out
        # Within a block of 8 rows, and the block that is being filled.
        for source, share in (("big", 0.5), ("mid", 0.3), (None, 0.2)):
            assert abs(done[source] - share * at) < 2 * 8
    assert at > 1500


def test_block_counts_at_block_ends(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}") for i in range(3000)], "doc_id long, source string")
    weights = spark.createDataFrame([("s0", 0.5), ("s1", 0.3), ("s2", 0.2)], "source string, weight double")
    found = sorted(mixing.mix(docs, weights, parts=10, block_rows=5).collect(), key=lambda r: r.position)
    for blocks in range(1, 300):
        head = Counter(r.source for r in found[: blocks * 5])
        for source, share in (("s0", 0.5), ("s1", 0.3), ("s2", 0.2)):
            assert abs(head[source] / 5 - share * blocks) < 1 + 1e-9


def test_odd_rows(spark):
    rows = [(None, None, 1), (None, "a", 1), (7, "a", 1), (7, "a", 1), (8, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, position int")
    bad = spark.createDataFrame([("a", None), ("b", -1.0)], "source string, weight double")
    for weights in (None, bad, bad.limit(0)):
        found = mixing.mix(docs, weights, with_row=True).collect()
        assert sorted(r.position for r in found) == list(range(5))
        assert sorted(map(str, (tuple(r.row) for r in found))) == sorted(map(str, rows))
    assert mixing.mix(docs.limit(0)).count() == 0
    assert sorted(map(str, map(tuple, mixing.in_mixed_order(docs).collect()))) == sorted(map(str, rows))
    with pytest.raises(ValueError):
        mixing.mix(spark.range(mixing.MAX_SOURCES + 1).selectExpr("id doc_id", "cast(id as string) source"))
