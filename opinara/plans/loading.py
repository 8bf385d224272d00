"""From two paths to prepared, keyed and possibly sampled train and test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.operators.prep import prepare
from opinara.operators.sampling import hash_sample
from opinara.settings import SourceSettings
from opinara.sources.reviews import format_of, read_reviews, with_file_key

KEY = "review_id"


def load_split(spark: SparkSession, path: str, settings: SourceSettings = SourceSettings()) -> DataFrame:
    """One split. Parquet rows are keyed by their place, CSV rows by their content.

    Copies in CSV thus share a key: enough for sampling by fraction, which keeps or drops
    them together; write CSV as Parquet first where keys must be unique.
    """
    raw = read_reviews(spark, path, settings.schema, settings.header, settings.fmt, settings.multiline)
    columns = raw.columns
    keyed = (
        with_file_key(raw, KEY, path)
        if format_of(path, settings.fmt) == "parquet"
        else raw.withColumn(KEY, F.xxhash64(*columns))
    )
    return hash_sample(prepare(keyed), KEY, settings.sample_fraction)


def load_splits(
    spark: SparkSession, settings: SourceSettings = SourceSettings()
) -> tuple[DataFrame, DataFrame]:
    """Train and test with polarity, title, text, review_id, combined_text and label."""
    return (
        load_split(spark, settings.train_path, settings),
        load_split(spark, settings.test_path, settings),
    )
