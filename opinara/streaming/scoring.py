"""Scoring reviews as they arrive. Stateless: each row is scored on its own."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from opinara.functions.predictions import confidence, positive_probability, verdict
from opinara.functions.text import is_blank
from opinara.operators.prep import keep, release


def review_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files below ``path``, old and new, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def verdicts(reviews: DataFrame, model: PipelineModel, key: str, text: str = "text") -> DataFrame:
    """Readable verdict per review; blank ones and those without text are rejected. Batch and stream alike."""
    inputs = reviews.filter(~is_blank(F.col(text))).select(key, F.lower(text).alias("combined_text"))
    scored = model.transform(inputs).withColumn("prob", positive_probability())
    return scored.select(
        key,
        "prediction",
        "prob",
        verdict(F.col("prediction")).alias("sentiment"),
        confidence(F.col("prob")).alias("confidence"),
    )


VERDICTS, REJECTED, COUNTS, BATCH = "verdicts", "rejected", "counts", "batch_id"


class BatchWriter:
    """Writes each micro-batch to the partition of its number, so that writing it again changes nothing.

    Below ``sink`` are three tables: ``verdicts``; ``rejected``, the reviews with blank or no text as they came;
    and ``counts``, a row for each batch with the rows read, scored and rejected, observed while verdicts are written.
    A batch counts as written with its row in ``counts``, which comes last. A stream hands over batches of a session of its
    own, as :func:`opinara.sources.reviews.counted` asks for.
    """

    def __init__(self, model: PipelineModel, key: str, sink: str, text: str = "text"):
        self.model, self.key, self.sink, self.text = model, key, sink, text

    def __call__(self, batch: DataFrame, number: int) -> None:
        # Written to two tables, but read and parsed once.
        batch = keep(batch)
        try:
            blank = F.coalesce(is_blank(F.col(self.text)), F.lit(True))
            seen = Observation()
            read = batch.observe(seen, F.count(F.lit(1)).alias("n_read"), F.count_if(blank).alias("n_rejected"))
            self._put(verdicts(read, self.model, self.key, self.text), VERDICTS, number)
            self._put(batch.filter(blank).select(self.key, self.text), REJECTED, number)
            found = seen.get
            counts = [(found["n_read"], found["n_read"] - found["n_rejected"], found["n_rejected"])]
            schema = "n_read long, n_scored long, n_rejected long"
            self._put(batch.sparkSession.createDataFrame(counts, schema), COUNTS, number)
        finally:
            release(batch)

    def _put(self, rows: DataFrame, name: str, number: int) -> None:
        writer = rows.withColumn(BATCH, F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH).parquet(f"{self.sink}/{name}")


def score_stream(
    reviews: DataFrame, model: PipelineModel, key: str, sink: str, checkpoint: str, text: str = "text"
) -> StreamingQuery:
    """Write verdicts of everything available below ``sink``, then stop; see :class:`BatchWriter`.

    The checkpoint makes a restart go on where the last run ended. The batch it was in is then written again, to
    the same partitions.
    """
    return (
        reviews.writeStream.foreachBatch(BatchWriter(model, key, sink, text))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_sink(spark: SparkSession, sink: str, name: str = VERDICTS) -> DataFrame:
    """One of the tables of a sink, with the number of each row's batch."""
    return spark.read.parquet(f"{sink}/{name}")
