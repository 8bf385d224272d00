import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinara.operators import profile, words
from opinara.operators.vocabulary import most_frequent, term_counts, term_stats, tfidf, vocabulary


@pytest.fixture(scope="module")
def lengths(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 900, 400), np.full(300, 60), rng.integers(0, 60, 200)])
    rows = [(i, float(i % 2), int(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, label double, n int").repartition(5).cache()


def test_histogram_equals_numpy(lengths):
    values = np.minimum([r.n for r in lengths.collect()], 500)
    expected, edges = np.histogram(values, bins=100)
    got = profile.length_histogram(lengths, {"n": ("n", 500)}, 100).orderBy("bin").collect()
    assert [r.cnt for r in got] == list(expected)
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1], abs=1e-6)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(7,)] * 5, "n int")
    got = profile.length_histogram(df, {"n": ("n", 500)}, 10).orderBy("bin").collect()
    expected, edges = np.histogram([7] * 5, bins=10)
    assert [r.cnt for r in got] == list(expected) and got[0].bin_start == edges[0]


def test_continuous_histogram_by_series(spark):
    rng = np.random.default_rng(5)
    values = rng.random(500)
    df = spark.createDataFrame([(int(i % 3 == 0), float(v)) for i, v in enumerate(values)], "s int, v double")
    got = profile.histogram(df, "v", 50, "s", (0, 1)).orderBy("s", "bin").collect()
    expected = [np.histogram([v for i, v in enumerate(values) if int(i % 3 == 0) == s], bins=50)[0] for s in (0, 1)]
    assert [r.cnt for r in got] == list(np.concatenate(expected))


def test_density_equals_the_direct_sum(lengths):
    got = profile.density(lengths, "n", 500, "label", points=40).filter("label = 1").orderBy("point").collect()
    values = np.array([min(r.n, 500) for r in lengths.collect() if r.label == 1], dtype=float)
    width = len(values) ** -0.2 * values.std(ddof=1)
    low, spread = values.min(), values.max() - values.min()
    grid = np.linspace(low - 0.5 * spread, low + 1.5 * spread, 40)
    direct = [np.exp(-0.5 * ((x - values) / width) ** 2).sum() / (len(values) * width * np.sqrt(2 * np.pi)) for x in grid]
    assert [r.density for r in got] == pytest.approx(direct, abs=1e-9)


def test_summary_equals_pandas(lengths):
    expected = pd.Series([r.n for r in lengths.collect()]).describe().round(1)
    got = profile.summary(lengths, {"n": "n"}).first()
    assert list(got)[1:] == list(expected)


def test_a_class_without_spread_is_shown_without_density(spark):
    df = spark.createDataFrame([(1.0, 5), (0.0, 7), (0.0, 7), (2.0, 1), (2.0, 3), (None, None)], "label double, n int")
    got = profile.density(df, "n", 500, "label", points=9)
    flat = got.filter("label < 2").orderBy("label").collect()
    assert [(r.label, r.point, r.x, r.density) for r in flat] == [(0.0, 0, 7.0, None), (1.0, 0, 5.0, None)]
    assert got.filter("label = 2 and density > 0").count() == 9 and got.count() == 11


def test_one_row_has_no_deviation(spark):
    df = spark.createDataFrame([(1.0, 5)], "label double, n int")
    got = profile.summary(df, {"n": "n"}).first()
    assert got.std is None and got.p50 == got.mean == 5.0


def test_values_that_are_no_numbers_have_a_bin_of_their_own(spark):
    """Null, NaN and infinite scores leave the range and the other bins as they would be without them."""
    numbers = [0.1, 0.2, 0.2, 0.9]
    odd = [None, float("nan"), float("inf"), float("-inf"), float("nan")]
    rows = [(1, v) for v in numbers + odd] + [(0, v) for v in odd[:2]]
    df = spark.createDataFrame(rows, "s int, v double")
    got = profile.histogram(df, "v", 5, "s", (0, 1)).collect()
    clean = profile.histogram(df.filter("s = 1 and v between 0 and 1"), "v", 5, "s", (0, 1)).collect()
    assert sorted(r for r in got if r.bin >= 0) == sorted(clean)
    assert {(r.s, r.bin_start, r.cnt) for r in got if r.bin == profile.NO_NUMBER} == {(1, None, 5), (0, None, 2)}


def test_lengths_that_are_missing(spark):
    df = spark.createDataFrame([(3,), (9,), (None,), (None,)], "n int")
    got = {r.bin: r.cnt for r in profile.length_histogram(df, {"n": ("n", 5)}, 2).collect()}
    assert got == {0: 1, 1: 1, profile.NO_NUMBER: 2}
    row = profile.summary(df, {"n": "n"}).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (2, 6.0, 3.0, 9.0)


def test_one_table_of_counts_serves_every_profile(spark):
    """Each result from shared counts equals the one from its own scan."""
    rng = np.random.default_rng(9)
    rows = [(i, float(i % 2), int(rng.integers(0, 700)), int(rng.integers(0, 9)), ["a", "b"][: i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label double, n int, m int, words array<string>")
    counts = profile.value_counts(df, {"n": F.col("n"), "m": F.col("m")}, ("label",), F.col("words"))
    lengths = counts.filter(F.col("series") != profile.TERMS).groupBy("series", "value").agg(F.sum("cnt").alias("cnt"))

    def same(one, two):
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))

    measures = {"x": ("n", 500), "y": ("m", 5)}
    same(profile.histogram_of_counts(profile.clipped(lengths, measures), 20), profile.length_histogram(df, measures, 20))
    same(profile.summary_of_counts(lengths), profile.summary(df, {"n": "n", "m": "m"}))
    by_class = counts.filter("series = 'm'").groupBy("label", "value").agg(F.sum("cnt").alias("cnt"))
    same(profile.density_of_counts(by_class, "label", 30), profile.density(df, "m", 99, "label", 30))
    terms = {(r.label, r.term): r.cnt for r in counts.filter(F.col("series") == profile.TERMS).collect()}
    assert sum(terms.values()) == sum(len(r[4]) for r in rows) and len(terms) == 4


@pytest.mark.parametrize("min_df", [2, 0.5])
def test_documents_are_counted_with_the_terms(spark, min_df):
    rows = [(1, ["a", "b", "a"]), (2, ["a"]), (3, []), (4, None), (5, ["b", None])]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    stats = {r.term: (r.cnt, r.df) for r in term_stats(df, "t", documents=True).collect()}
    assert stats == {None: (0, 5), "a": (3, 2), "b": (2, 2)}
    found = {(r.id, r.term): r.tfidf for r in tfidf(df, "id", "t", min_df=min_df).collect()}
    expected = {} if min_df < 1 else {(1, "a"): 2, (1, "b"): 1, (2, "a"): 1, (5, "b"): 1}
    assert found == pytest.approx({k: tf * np.log(6 / 3) for k, tf in expected.items()})




def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([(0.0, "bb aa the AA cc bb"), (1.0, "zz x the")], "label double, combined_text string")
    got = words.top_words(df, k=2).orderBy("label", "rank").collect()
    assert [(r.label, r.word, r.cnt) for r in got] == [(0.0, "aa", 2), (0.0, "bb", 2), (1.0, "zz", 1)]
    assert {r.weight for r in words.word_weights(df, k=3).filter("label = 0").collect()} == {1.0, 0.5}


@pytest.fixture(scope="module")
def pieces(spark):
    """One term in every row and often; many terms with equal counts."""
    rows = [(i, ["hot"] * 3 + [f"t{(i * k) % 97}" for k in range(1, 12)]) for i in range(300)]
    return spark.createDataFrame(rows, "id int, filtered_tokens array<string>").cache()


def brute_stats(pieces):
    cnt, df = {}, {}
    for row in pieces.collect():
        for term in row.filtered_tokens:
            cnt[term] = cnt.get(term, 0) + 1
        for term in set(row.filtered_tokens):
            df[term] = df.get(term, 0) + 1
    return cnt, df


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("size", [1, 10, 50, 1000])
def test_vocabulary_is_exact_and_ordered(pieces, parts, size):
    cnt, df = brute_stats(pieces)
    kept = [t for t in cnt if df[t] >= 30]
    expected = [(t, cnt[t], df[t]) for t in sorted(kept, key=lambda t: (-cnt[t], t))[:size]]
    got = vocabulary(pieces.repartition(parts), size=size, min_df=30).orderBy("idx").collect()
    assert [(r.term, r.cnt, r.df) for r in got] == expected
    assert [r.idx for r in got] == list(range(len(expected)))


def test_vocabulary_with_a_share_as_minimum(pieces):
    assert [r.term for r in vocabulary(pieces, min_df=0.99).collect()] == ["hot"]


def test_most_frequent_with_one_magnitude(spark):
    terms = spark.createDataFrame([(f"w{i:03d}", 5) for i in range(200)], "term string, cnt long")
    got = most_frequent(terms, 7).orderBy("idx").collect()
    assert [r.term for r in got] == [f"w{i:03d}" for i in range(7)]


def test_term_statistics_per_level(pieces):
    cnt, df = brute_stats(pieces)
    even = pieces.withColumn("even", F.col("id") % 2)
    for row in term_stats(even, "filtered_tokens", "even", (0, 1)).collect():
        assert (row.cnt, row.df) == (cnt[row.term], df[row.term])
        assert row.cnt_0 + row.cnt_1 == row.cnt


def test_counts_and_tfidf(pieces):
    counts = term_counts(pieces, "id", size=10, min_df=1)
    assert counts.filter("id = 0 and term = 'hot'").first().cnt == 3
    row = tfidf(pieces, "id", size=10, min_df=1).filter("id = 0 and term = 'hot'").first()
    assert row.tfidf == pytest.approx(3 * np.log(301 / 301))
    wide = tfidf(pieces, "id", size=300_000, min_df=1)
    assert wide.count() == pieces.select("id", F.explode("filtered_tokens")).distinct().count()
