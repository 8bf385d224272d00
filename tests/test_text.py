import pytest
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from opinara.functions import text
from opinara.functions.stopwords import ENGLISH

EDGE_CASES = {
    "a  b": ["a", "", "b"],
    " a": ["", "a"],
    "": [""],
    "a b ": ["a", "b"],
    "A\tB\nc": ["a", "b", "c"],
    "x y": ["x y"],
    "   ": [],
    "a  ": ["a", " "],
    "x\x0b\x0cy\r": ["x", "", "y"],
}


def test_stop_words_are_sparks(spark):
    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_on_edge_cases(spark):
    df = spark.createDataFrame([(t,) for t in EDGE_CASES], "combined_text string")
    both = Tokenizer(inputCol="combined_text", outputCol="ml").transform(
        df.withColumn("own", text.tokens(F.col("combined_text")))
    )
    for row in both.collect():
        assert row.own == row.ml == EDGE_CASES[row.combined_text]


@pytest.mark.parametrize("table", ["documents", "conversations", "benchmark", "pages"])
def test_token_columns_equal_the_ml_stages(spark, small_dir, table):
    source = "html" if table == "pages" else "text"
    df = spark.read.parquet(f"{small_dir}/{table}.parquet").select(F.col(source).alias("x"))
    ml = Tokenizer(inputCol="x", outputCol="t").transform(df)
    ml = StopWordsRemover(inputCol="t", outputCol="f").transform(ml)
    ml = NGram(n=2, inputCol="f", outputCol="g").transform(ml)
    own = text.tokens(F.col("x"))
    kept = text.without_stop_words(F.col("t"))
    grams = text.ngrams(F.col("f"))
    unequal = ml.filter((own != F.col("t")) | (kept != F.col("f")) | (grams != F.col("g")))
    assert ml.count() > 0 and unequal.count() == 0


def test_ngrams_of_short_arrays(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "p array<string>")
    got = [row.g for row in df.select(text.ngrams(F.col("p"), 2).alias("g")).collect()]
    assert got == [[], [], ["a b", "b c"]]
    got = [row.g for row in df.select(text.ngrams(F.col("p"), 3).alias("g")).collect()]
    assert got == [[], [], ["a b c"]]


def test_word_count_and_words(spark):
    df = spark.createDataFrame([("  a\tbc \n d  ",), ("",), ("  ",)], "x string")
    assert [r[0] for r in df.select(text.word_count(F.col("x"))).collect()] == [3, 0, 0]
    df = spark.createDataFrame([("Été a über_x 42!",)], "x string")
    assert df.select(text.words(F.col("x"))).first()[0] == ["été", "über_x", "42"]


def test_length_buckets_are_left_closed(spark):
    lengths = [0, 99, 100, 299, 300, 499, 500, 999, 1000, 50_000]
    df = spark.createDataFrame([(n,) for n in lengths], "n int")
    got = df.select("n", text.length_bucket(F.col("n")).alias("b"), text.length_bucket_no(F.col("n")).alias("i"))
    names = ["0-100", "100-300", "300-500", "500-1000", "1000+"]
    assert [(r.b, r.i) for r in got.orderBy("n").collect()] == [(names[i // 2], i // 2) for i in range(10)]
