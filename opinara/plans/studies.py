"""Studies over several fits: the comparison grid and the scaling study.

The loops run over a handful of specifications; each step inside them is a Spark job over
the whole table.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from opinara.functions.ranks import below_fraction, hash_rank
from opinara.operators.metrics import classification_metrics
from opinara.operators.prep import keep, release
from opinara.operators.runs import METRICS, RUNS_SCHEMA, run_id
from opinara.plans.features import NoTerms, text_stages, weighting_stages
from opinara.plans.models import classifier, full_pipeline, score
from opinara.session import fresh_path
from opinara.settings import SEED, FeatureSettings

log = logging.getLogger(__name__)

# What ends one run or fraction only: a job that Spark gave up, or data too small for any vocabulary.
FAILURES = (CapturedException, Py4JJavaError, ValueError)
# Of these, what says something about the sample and nothing about the job.
SMALL = (NoTerms,)
PARALLEL = 2
FRACTIONS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 1.0)

SCALING_SCHEMA = StructType(
    [
        StructField("fraction", DoubleType()),
        StructField("n_rows", LongType()),
        StructField("training_time", DoubleType()),
        StructField("accuracy", DoubleType()),
        StructField("throughput", DoubleType()),
        StructField("error", StringType()),
    ]
)


@dataclass(frozen=True)
class RunSpec:
    model: str
    feature_type: str
    settings: FeatureSettings = FeatureSettings()

    def params(self, overrides: Mapping[str, object] | None = None) -> dict[str, object]:
        """All that tells this run from others of its model and features."""
        settings = {"vocab_size": self.settings.vocab_size, "min_df": self.settings.min_df, "ngram": self.settings.ngram}
        return settings | dict(overrides or {})

    def run_id(self, overrides: Mapping[str, object] | None = None) -> str:
        return run_id(self.model, self.feature_type, self.params(overrides))


def default_grid(
    settings: FeatureSettings = FeatureSettings(), trees: FeatureSettings | None = None
) -> list[RunSpec]:
    """Eight runs; ``trees`` gives the tree models another vocabulary than the rest."""
    linear = ["count_vectorizer", "tfidf", "ngram_cv", "ngram_tfidf"]
    return [
        *[RunSpec("logistic_regression", features, settings) for features in linear],
        *[RunSpec("naive_bayes", features, settings) for features in linear[:2]],
        *[RunSpec(model, "count_vectorizer", trees or settings) for model in ("random_forest", "gbt")],
    ]


@dataclass
class GridResult:
    """Runs table, and the run of highest accuracy with its model.

    ``best`` is None where every run failed, ``best_model`` also where the best run was logged earlier.
    """

    runs: DataFrame
    best: RunSpec | None
    best_model: PipelineModel | None


class SharedFeatures:
    """Feature stages of a grid, each fitted by the run that needs it first; the others wait for it."""

    def __init__(self, tokenized: DataFrame):
        self.tokenized, self.fits, self.lock = tokenized, {}, threading.Lock()

    def fitted(self, feature_type: str, settings: FeatureSettings) -> tuple[PipelineModel, float]:
        """The stages, and the seconds their fit took."""
        named = (feature_type, settings)
        with self.lock:
            first = named not in self.fits
            fit = self.fits.setdefault(named, Future())
        if first:
            try:
                started = time.monotonic()
                model = Pipeline(stages=weighting_stages(*named)).fit(self.tokenized)
                fit.set_result((model, time.monotonic() - started))
            except BaseException as failure:
                fit.set_exception(failure)
        return fit.result()


@dataclass
class Best:
    """The best run so far and its model; models of other runs are let go."""

    accuracy: float | None = None
    seq: int | None = None
    model: PipelineModel | None = None

    def offer(self, row: dict, model: PipelineModel | None) -> None:
        """Higher accuracy wins, then the earlier place in the grid, whenever it ended."""
        accuracy, seq = row["accuracy"], row["seq"]
        if accuracy is not None and (self.accuracy is None or (-accuracy, seq) < (-self.accuracy, self.seq)):
            self.accuracy, self.seq, self.model = accuracy, seq, model


OnRun = Callable[[RunSpec, dict, PipelineModel | None], None]


def run_grid(
    spark: SparkSession, train: DataFrame, test: DataFrame, specs: Sequence[RunSpec],
    key: str, overrides: Mapping[str, dict] | None = None, on_run: OnRun | None = None,
    logged: Mapping[str, dict] | None = None, parallel: int = PARALLEL,
) -> GridResult:
    """Fit and evaluate every specification; a failing one becomes a row with its error.

    ``parallel`` runs go on at once, each from a thread whose jobs carry the run's name as their group and
    as their scheduler pool: with ``spark.scheduler.mode=FAIR`` the pools share the cluster, so that the small
    last stages of one fit do not leave it idle. Seconds are those on the clock, others' work included;
    one at a time gives times that compare.

    Text is tokenized once for all runs, and runs with equal features share one fit of them;
    its time counts for each. Only what a run needs is cached: class and tokens.

    ``on_run`` is called as soon as a run has ended, by one thread at a time. What it raises ends the study:
    runs that have not begun are not begun. Runs that ``logged`` holds by their id are not run again.
    """
    overrides, logged = overrides or {}, logged or {}
    ids = [spec.run_id(overrides.get(spec.model)) for spec in specs]
    rows: dict[int, dict] = {}
    best, lock = Best(), threading.Lock()
    for seq, spec in enumerate(specs):
        if ids[seq] in logged:
            rows[seq] = _row_of_log(seq, spec, logged[ids[seq]])
            best.offer(rows[seq], None)
    todo = [seq for seq in range(len(specs)) if seq not in rows]
    if todo:
        text = PipelineModel(stages=text_stages())
        tokenized, held_out = (
            keep(text.transform(part.select(key, "label", "combined_text")).select(key, "label", "filtered_tokens"))
            for part in (train, test)
        )
        features, failed = SharedFeatures(tokenized), threading.Event()

        def work(seq: int) -> None:
            if failed.is_set():
                return
            spec, row = specs[seq], _empty_row(seq, specs[seq])
            context = spark.sparkContext
            context.setJobGroup(ids[seq], f"run {seq}: {spec.model} on {spec.feature_type}")
            context.setLocalProperty("spark.scheduler.pool", ids[seq])
            model = None
            try:
                fitted, row["training_time"] = _timed_fit(spec, features, overrides.get(spec.model, {}))
                row |= classification_metrics(score(fitted, held_out, key, "label")).first().asDict()
                model = PipelineModel(stages=[*text.stages, *fitted.stages])
            except FAILURES as failure:  # one run must not end the study
                log.warning("run %s on %s failed: %s", spec.model, spec.feature_type, failure)
                row["error"] = str(failure)
            with lock:
                rows[seq] = row
                best.offer(row, model)
                if on_run is not None and not failed.is_set():
                    try:
                        on_run(spec, row, model)
                    except BaseException:
                        failed.set()
                        raise

        try:
            with ThreadPoolExecutor(max(parallel, 1)) as threads:
                started = [threads.submit(inheritable_thread_target(spark)(work), seq) for seq in todo]
            for one in started:
                one.result()
        finally:
            release(tokenized)
            release(held_out)
    runs = spark.createDataFrame([rows[seq] for seq in sorted(rows)], RUNS_SCHEMA)
    return GridResult(runs, None if best.seq is None else specs[best.seq], best.model)


def _empty_row(seq: int, spec: RunSpec) -> dict:
    return dict.fromkeys(RUNS_SCHEMA.names) | {"seq": seq, "model": spec.model, "feature_type": spec.feature_type}


def _row_of_log(seq: int, spec: RunSpec, entry: dict) -> dict:
    metrics = entry["metrics"]
    found = {name: metrics.get(name) for name in METRICS}
    return _empty_row(seq, spec) | found | {"training_time": metrics.get("training_time_seconds")}


def _timed_fit(spec: RunSpec, features: SharedFeatures, overrides: Mapping[str, object]) -> tuple[PipelineModel, float]:
    """Features and classifier of one run, and the seconds both took to fit."""
    weighting, seconds = features.fitted(spec.feature_type, spec.settings)
    started = time.monotonic()
    model = classifier(spec.model, **overrides).fit(weighting.transform(features.tokenized))
    return PipelineModel(stages=[*weighting.stages, model]), seconds + time.monotonic() - started


def slice_of(rank: Column, fractions: Sequence[float]) -> Column:
    """Which of the rising ``fractions`` a rank first falls in; null beyond the last."""
    chosen = F.lit(None).cast("int")
    for number, fraction in reversed(list(enumerate(fractions))):
        inside = F.lit(True) if fraction >= 1.0 else below_fraction(rank, fraction)
        chosen = F.when(inside, F.lit(number)).otherwise(chosen)
    return chosen


def write_slices(train: DataFrame, key: str, fractions: Sequence[float], seed: int = SEED) -> str:
    """The rows by slice, as partitions of one table: the first ``i + 1`` slices are the sample of fraction ``i``.

    Samples are the same as :func:`hash_sample` draws, but each row is read and written once for all of them.
    """
    path = fresh_path(train.sparkSession, "slices")
    rows = train.select("label", "combined_text", slice_of(hash_rank(key, seed), fractions).alias("slice"))
    rows.filter("slice is not null").write.partitionBy("slice").parquet(path)
    return path


def read_slices(spark: SparkSession, path: str, last: int) -> DataFrame:
    """Slices up to ``last``; the partitions of the others are not read."""
    schema = "label double, combined_text string, slice int"
    return spark.read.schema(schema).parquet(path).filter(F.col("slice") <= last).drop("slice")


def scaling_study(
    spark: SparkSession, train: DataFrame, test: DataFrame, key: str,
    fractions: Sequence[float] = FRACTIONS, model: str = "logistic_regression",
    feature_type: str = "count_vectorizer", settings: FeatureSettings = FeatureSettings(),
    failures: tuple[type[Exception], ...] = FAILURES,
) -> DataFrame:
    """Time, accuracy and rows per second of one pipeline on growing, nested samples.

    The test rows are tokenized once for all fractions. Without any, there is no accuracy.

    A fraction that one of ``failures`` ends becomes a row with its error, anything else ends the study. Who leaves
    out the errors takes ``SMALL``, so that a row without accuracy never stands for a job that failed.
    """
    fractions = sorted(set(fractions))
    text = PipelineModel(stages=text_stages())
    path = write_slices(train, key, fractions)
    held_out = keep(text.transform(test.select("label", "combined_text")).select("label", "filtered_tokens"))
    rows = []
    try:
        for number, fraction in enumerate(fractions):
            # Counted and fitted from the same cached sample.
            sample = keep(read_slices(spark, path, number))
            row = {"fraction": float(fraction), "n_rows": sample.count()}
            try:
                started = time.monotonic()
                fitted = full_pipeline(feature_type, model, settings).fit(sample)
                row["training_time"] = time.monotonic() - started
                from_tokens = PipelineModel(stages=fitted.stages[len(text.stages) :])
                accuracy = classification_metrics(score(from_tokens, held_out, "label"), score=None).first().accuracy
                # Zero is also what no rows give.
                row["accuracy"] = None if accuracy == 0 and held_out.isEmpty() else accuracy
                row["throughput"] = row["n_rows"] / row["training_time"]
            except failures as failure:  # a sample can be too small for any vocabulary
                log.warning("fraction %s failed: %s", fraction, failure)
                row |= {"training_time": None, "error": str(failure)}
            finally:
                release(sample)
            rows.append({**dict.fromkeys(SCALING_SCHEMA.names), **row})
    finally:
        release(held_out)
    return spark.createDataFrame(rows, SCALING_SCHEMA)


def scaling_summary(study: DataFrame) -> DataFrame:
    """Peak throughput, accuracy on the smallest and the whole table, gain from a quarter on."""

    def accuracy_at(fraction: float):
        return F.max(F.when(F.col("fraction") == fraction, F.col("accuracy")))

    return study.agg(
        F.max("throughput").alias("peak_throughput"),
        accuracy_at(0.01).alias("accuracy_at_1_pct"),
        accuracy_at(1.0).alias("accuracy_at_100_pct"),
        (accuracy_at(1.0) - accuracy_at(0.25)).alias("gain_from_25_pct"),
    )
