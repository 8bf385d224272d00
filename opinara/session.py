"""Session start-up and the one place that decides where intermediate data goes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import opinara
from opinara.settings import SessionSettings

_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def session(settings: SessionSettings = SessionSettings()) -> SparkSession:
    """Get or create the session; memory settings only count before the JVM starts."""
    builder = (
        SparkSession.builder.appName(settings.app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Runs of a study share the cluster, each in a pool of its own.
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in (
        ("spark.driver.memory", settings.driver_memory),
        ("spark.executor.memory", settings.executor_memory),
        *settings.extra.items(),
    ):
        if value is not None:
            builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: on a
    cluster a machine-local folder would be lost with the machine that holds it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="opinara-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and cut its lineage there.

    Reliable checkpoint: the files outlive any executor, unlike cached blocks.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`materialize`, but in columns, so that readers take only what they need."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package sent along, so that executors need no copy of it."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def ship(spark: SparkSession) -> None:
    """Hand the package's source to Spark, which brings it to each executor; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(opinara.__file__).parent
    folder = tempfile.TemporaryDirectory()  # the driver's own copy, served to executors until it ends
    archive = Path(folder.name) / "opinara-source.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped[context.applicationId] = folder
