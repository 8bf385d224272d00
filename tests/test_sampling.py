import hashlib

import pytest
from pyspark.sql import functions as F

from opinara.operators import sampling


def rank(key, seed=42):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:15], 16)


@pytest.fixture(scope="module")
def skewed(spark):
    """A rare class next to one that holds almost everything."""
    df = spark.range(5000).withColumn("label", F.when(F.col("id") % 50 == 0, 0.0).otherwise(1.0))
    return df.repartition(5).cache()


def test_bernoulli_samples_are_nested_and_stable(skewed):
    ids = [{r.id for r in sampling.hash_sample(skewed, "id", f).collect()} for f in (0.05, 0.1, 0.5)]
    assert ids[0] < ids[1] < ids[2]
    assert ids[1] == {r.id for r in sampling.hash_sample(skewed.repartition(7), "id", 0.1).collect()}
    assert ids[1] == {i for i in range(5000) if rank(i) < int(0.1 * 2**60)}
    assert sampling.hash_sample(skewed, "id", 1.0) is skewed


@pytest.mark.parametrize("n", [0, 1, 37, 4999, 5000, 9999])
def test_exact_sample(skewed, n):
    expected = set(sorted(range(5000), key=lambda i: (rank(i), i))[:n])
    assert {r.id for r in sampling.sample_n(skewed, "id", n).collect()} == expected


def test_exact_sample_of_nothing(spark):
    assert sampling.sample_n(spark.range(0), "id", 3).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_sample_per_class(skewed, parts):
    picked = sampling.sample_per_class(skewed.repartition(parts), "id", 150).collect()
    expected = set()
    for rare in (True, False):
        ids = [i for i in range(5000) if (i % 50 == 0) == rare]
        expected |= set(sorted(ids, key=lambda i: (rank(i), i))[:150])
    assert {r.id for r in picked} == expected and len(picked) == 250


def test_seed_changes_the_sample(skewed):
    one, two = ({r.id for r in sampling.sample_n(skewed, "id", 100, seed=s).collect()} for s in (1, 2))
    assert one != two


def test_stratified_split_keeps_shares_and_rows(skewed):
    parts = sampling.stratified_split(skewed, "id", 0.1)
    counts = {(r.label, r.part): r["count"] for r in parts.groupBy("label", "part").count().collect()}
    assert counts == {
        (0.0, "validation"): 10, (0.0, "train"): 90,
        (1.0, "validation"): 490, (1.0, "train"): 4410,
    }
    assert parts.select("id").distinct().count() == 5000


def test_every_class_is_sampled_and_split(spark):
    """Classes nobody listed, and rows without one, are classes like the others."""
    rows = [(i, float(i % 4)) for i in range(40)] + [(i, None) for i in range(40, 60)]
    df = spark.createDataFrame(rows, "id int, label double").repartition(3)
    split = sampling.stratified_split(df, "id", 0.3).groupBy("label", "part").count().collect()
    counts = {(r.label, r.part): r["count"] for r in split}
    assert counts == {
        **{(float(c), part): n for c in range(4) for part, n in (("validation", 3), ("train", 7))},
        (None, "validation"): 6, (None, "train"): 14,
    }
    picked = sampling.sample_per_class(df, "id", 7).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in picked} == {None: 7, **{float(c): 7 for c in range(4)}}
    assert sampling.stratified_split(df, "id", 1.0).filter("part = 'train'").count() == 0
    assert sampling.stratified_split(df, "id", 0.0).filter("part = 'train'").count() == 60


@pytest.mark.parametrize("n", [0, 1, 3, 100, 101, 349, 350, 500])
def test_exact_sizes_under_shared_and_null_keys(spark, n):
    """One key on most rows, a null on others: still exactly n rows, whole rows of df, none twice."""
    rows = [(7, f"hot{i}") for i in range(200)] + [(None, f"null{i}") for i in range(100)] + [(i, f"own{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(6)
    picked = sampling.sample_n(df, "id", n).collect()
    assert len(picked) == len({r.text for r in picked}) == min(n, 350)
    assert {tuple(r) for r in picked} <= set(rows)
    # Ranks below that of the last row are in whole.
    by_key = {}
    for key, text in rows:
        by_key.setdefault(key, set()).add(text)
    taken = 0
    for key in sorted(by_key, key=lambda k: rank("" if k is None else k)):
        mine = {r.text for r in picked if r.id == key}
        assert len(mine) == max(0, min(len(by_key[key]), n - taken))
        taken += len(by_key[key])


def test_rows_are_evaluated_once(spark):
    """All counting and the result come from one table written in one pass."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(900).withColumn("label", (F.col("id") % 3).cast("double")).mapInArrow(count, "id long, label double")
    assert sampling.sample_n(df, "id", 50).count() == 50 and seen.value == 900
    assert sampling.sample_per_class(df, "id", 50).count() == 150 and seen.value == 1800
    assert sampling.stratified_split(df, "id", 0.1).count() == 900 and seen.value == 2700


def test_a_shared_key_is_not_gathered(spark):
    """The last step ranks rows of one piece of the table only."""
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("id"), F.col("id").alias("n"))
    ranked = sampling._ranked(df, "id", 42, F.lit(0))
    assert ranked.groupBy(F.shiftright(sampling.ORDINAL, sampling.PIECE_BITS)).count().agg(F.max("count")).first()[0] == 500
    picked = {r.n for r in sampling.sample_n(df, "id", 1234).collect()}
    assert len(picked) == 1234


def test_ties_within_one_slice(spark, monkeypatch):
    """With a single slice every row is ranked exactly; with many, almost none are."""
    df = spark.range(300)
    many = {r.id for r in sampling.sample_n(df, "id", 77).collect()}
    monkeypatch.setattr(sampling, "SLICE_BITS", 1)
    assert {r.id for r in sampling.sample_n(df, "id", 77).collect()} == many
