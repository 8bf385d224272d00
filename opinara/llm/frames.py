"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.session import fresh_path, map_batches, materialize, ship

__all__ = ["documents_of", "map_batches", "materialize", "ship", "small_batches", "store", "table", "text_of"]

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_KEY, SPARK_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: str) -> Column:
    """The text, an empty one for a null."""
    return F.coalesce(F.col(text), F.lit(""))


def documents_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Two columns under fixed names, whatever else the table holds: key as long, text not null."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"))


def store(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into a table of the shared folder and read it back.

    Like ``materialize``, but in columns: for large tables, whose checkpoints would be several
    times the size. The shuffle files of the write go when it has ended, and not with the driver's next
    garbage collection, so that an operator takes the disk of its largest step and not of all steps.
    """
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Batches of at most ``BATCH_BYTES`` go to Python, unless the session sets another size than Spark's own.

    Spark's 64 MB are held several times over: in the JVM's buffers, in the worker, and as what is made of them.
    """
    if spark.conf.get(BATCH_KEY) == SPARK_BATCH:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)
