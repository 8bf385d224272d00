"""Tables of finished runs: logging, comparison, selection."""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, MapType, StringType, StructField, StructType,
)

METRICS = ("accuracy", "precision", "recall", "f1", "auc")
CHARTED = ("accuracy", "f1")

RUNS_SCHEMA = StructType(
    [
        StructField("seq", IntegerType()),
        StructField("model", StringType()),
        StructField("feature_type", StringType()),
        *[StructField(name, DoubleType()) for name in METRICS],
        StructField("training_time", DoubleType()),
        StructField("error", StringType()),
    ]
)
LOG_SCHEMA = StructType(
    [
        StructField("run_name", StringType()),
        StructField("params", MapType(StringType(), StringType())),
        StructField("metrics", MapType(StringType(), DoubleType())),
        StructField("artifacts", ArrayType(StringType())),
        StructField("run_id", StringType()),
    ]
)
# Runs end in several threads, but one log is written by one at a time.
_writing = threading.Lock()
EVALUATION_PREFIX = "^eval_"


def run_name() -> Column:
    return F.concat_ws("_", "model", "feature_type")


def run_label() -> Column:
    return F.concat_ws(" + ", "model", "feature_type")


def valid_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("accuracy").isNotNull())


def _decimals(value: Column, pattern: str) -> Column:
    return F.when(value.isNull(), "N/A").otherwise(F.format_string(pattern, value))


def comparison(runs: DataFrame) -> DataFrame:
    """Runs as text: four decimals or ``N/A``, seconds with one decimal."""
    present = [c for c in METRICS if c in runs.columns]
    return runs.select(
        "model",
        "feature_type",
        *[_decimals(F.col(c), "%.4f").alias(c) for c in present],
        _decimals(F.col("training_time"), "%.1fs").alias("training_time"),
    )


def comparison_series(runs: DataFrame) -> DataFrame:
    """Charted metrics in long form, one row per run and known value."""
    return (
        runs.select(run_label().alias("run"), *CHARTED)
        .unpivot(["run"], list(CHARTED), "metric", "value")
        .filter(F.col("value").isNotNull())
    )


def best_run(runs: DataFrame) -> DataFrame:
    """Highest accuracy; the earlier run wins a tie."""
    return valid_runs(runs).orderBy(F.desc("accuracy"), "seq").limit(1)


def metric_table(runs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Metrics down, the listed runs across."""
    long = runs.select(run_label().alias("run"), *METRICS).unpivot(
        ["run"], list(METRICS), "metric", "value"
    )
    return long.groupBy("metric").pivot("run", list(labels)).agg(F.first("value"))


def clean_metrics(metrics: Column) -> Column:
    """Drop the evaluation prefix of the names and the metrics without a value."""
    named = F.transform_keys(metrics, lambda name, _: F.regexp_replace(name, EVALUATION_PREFIX, ""))
    return F.map_filter(named, lambda _, value: value.isNotNull())


def params_digest(params: Mapping[str, object] | None) -> str:
    """Twelve digits that tell sets of parameters apart, whatever their order."""
    text = json.dumps({k: str(v) for k, v in (params or {}).items()}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:12]


def run_id(model: str, feature_type: str, params: Mapping[str, object] | None = None) -> str:
    """What a run is known by in the log: the same for the same work."""
    return "-".join((model, feature_type, params_digest(params)))


def log_entries(
    runs: DataFrame, params: Mapping[str, object] | None = None, artifacts: Sequence[str] = ()
) -> DataFrame:
    """Log rows of a runs table: what was run as params, what came out as metrics."""
    given = [F.lit(text) for pair in (params or {}).items() for text in (pair[0], str(pair[1]))]
    metrics = [
        part for name in METRICS for part in (F.lit(name), F.col(name).cast("double"))
    ]
    return runs.select(
        run_name().alias("run_name"),
        F.create_map(
            F.lit("model_name"), "model", F.lit("feature_type"), "feature_type", *given
        ).alias("params"),
        clean_metrics(
            F.create_map(*metrics, F.lit("training_time_seconds"), F.col("training_time"))
        ).alias("metrics"),
        F.array(*map(F.lit, artifacts)).cast("array<string>").alias("artifacts"),
        F.concat_ws("-", "model", "feature_type", F.lit(params_digest(params))).alias("run_id"),
    )


def put_log(entries: DataFrame, path: str) -> str:
    """Write log rows, each in the place of an earlier one of its ``run_id``; all others stay.

    A log is a table partitioned by run, of which only the partitions written to are replaced.
    """
    with _writing:
        writer = entries.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_id").parquet(path)
    return path


def log_run(
    spark: SparkSession, path: str, name: str, model: str, feature_type: str,
    params: Mapping[str, object], metrics: Mapping[str, object], training_time: float,
    artifacts: Sequence[str] = (),
) -> str:
    """Log one run at ``path``; logged again, it takes the place of its first entry."""
    numbers = {k: float(v) if isinstance(v, (int, float)) else None for k, v in metrics.items()}
    settings = {"model_name": model, "feature_type": feature_type}
    settings |= {k: str(v) for k, v in params.items()}
    numbers |= {"training_time_seconds": float(training_time)}
    row = [(name, settings, numbers, list(artifacts), run_id(model, feature_type, params | {"run_name": name}))]
    entry = spark.createDataFrame(row, LOG_SCHEMA)
    return put_log(entry.withColumn("metrics", clean_metrics(F.col("metrics"))), path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def logged_runs(spark: SparkSession, path: str, ids: Sequence[str]) -> dict[str, dict]:
    """Entries of the named runs by id; none where there is no log yet."""
    try:
        found = read_log(spark, path).filter(F.col("run_id").isin(*ids)).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {row.run_id: row.asDict() for row in found}


def write_runs_json(runs: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Valid runs as JSON lines."""
    valid_runs(runs).write.mode(mode).json(path)
    return path


def read_runs_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).json(path)


def write_scaling_json(study: DataFrame, path: str) -> str:
    """Rows of a scaling study as JSON lines, failed ones with their error."""
    study.write.mode("errorifexists").json(path)
    return path
