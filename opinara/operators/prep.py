"""From raw reviews to prepared reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from opinara.functions.ranks import below_fraction, hash_rank
from opinara.functions.text import is_blank, model_input, word_count
from opinara.settings import SEED

TEST_FRACTION = 0.2


def complete(df: DataFrame) -> list[Column]:
    """What makes a row complete: one condition per column, two where NaN is possible."""
    conditions = []
    for name, kind in df.dtypes:
        conditions.append(F.col(name).isNotNull())
        if kind in ("float", "double"):
            conditions.append(~F.isnan(name))
    return conditions


def drop_nulls(df: DataFrame) -> DataFrame:
    """Keep complete rows. Condition by condition, so that each can reach its scan."""
    for condition in complete(df):
        df = df.filter(condition)
    return df


def prepare_text(df: DataFrame) -> DataFrame:
    """Lower-case title and text and join them with one blank."""
    return df.withColumns(
        {"title": F.lower("title"), "text": F.lower("text")}
    ).withColumn("combined_text", F.concat_ws(" ", "title", "text"))


def label_of(polarity: Column) -> Column:
    """Class 0.0 for polarity 1, class 1.0 for anything else."""
    return F.when(polarity == 1, F.lit(0.0)).otherwise(F.lit(1.0))


def prepare(df: DataFrame) -> DataFrame:
    """Drop incomplete rows, normalise the text, add the class."""
    return prepare_text(drop_nulls(df)).withColumn("label", label_of(F.col("polarity")))


def with_split(df: DataFrame, key: str, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """Assign each row to train or test for good, from its key alone."""
    chosen = below_fraction(hash_rank(key, f"split-{SEED}"), test_fraction)
    return df.withColumn("split", F.when(chosen, "test").otherwise("train"))


def with_lengths(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "char_length": F.length("combined_text"),
            "word_count": word_count(F.col("combined_text")),
            "title_len": F.length("title"),
            "text_len": F.length("text"),
        }
    )


def keep(df: DataFrame) -> DataFrame:
    """Cache a table that several jobs read; lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release(df: DataFrame) -> None:
    df.unpersist()


def guarded_input(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``model_input``, the part a fixed-length model reads; rows with blank text go."""
    return df.filter(~is_blank(F.col(text))).withColumn("model_input", model_input(F.col(text)))
