"""Most frequent words per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.functions.stopwords import ENGLISH
from opinara.functions.text import words

TOP_WORDS = 30
CLOUD_WORDS = 200


def word_counts(df: DataFrame, text: str = "combined_text", by: str = "label") -> DataFrame:
    """Occurrences of each word per class, stop words left out."""
    return (
        df.select(by, F.explode(words(F.col(text))).alias("word"))
        .filter(~F.col("word").isin(*ENGLISH))
        .groupBy(by, "word")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def counted_words(text: str = "combined_text") -> Column:
    """The words that :func:`word_counts` counts, as an array."""
    return F.filter(words(F.col(text)), lambda word: ~word.isin(*ENGLISH))


def top_words(
    df: DataFrame, k: int = TOP_WORDS, text: str = "combined_text", by: str = "label"
) -> DataFrame:
    """The ``k`` most frequent words per class, ties in word order.

    Spark keeps only the first ``k`` per class in every task before it shuffles to the class.
    """
    return top_of_counts(word_counts(df, text, by), k, by)


def top_of_counts(counts: DataFrame, k: int = TOP_WORDS, by: str = "label") -> DataFrame:
    ranked = Window.partitionBy(by).orderBy(F.desc("cnt"), "word")
    return (
        counts.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
    )


def word_weights(
    df: DataFrame, k: int = CLOUD_WORDS, text: str = "combined_text", by: str = "label"
) -> DataFrame:
    """Top words with their frequency relative to the class's most frequent word."""
    return weights_of_top(top_words(df, k, text, by), by)


def weights_of_top(top: DataFrame, by: str = "label") -> DataFrame:
    return top.withColumn("weight", F.col("cnt") / F.max("cnt").over(Window.partitionBy(by)))
