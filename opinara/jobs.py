"""The whole jobs a user submits: conform, profile, train, scale, analyse errors, export.

Each reads and writes tables by path; every result table is written by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.functions.text import clip, preview
from opinara.operators import curves, errors, metrics, profile, words
from opinara.operators.prep import with_lengths
from opinara.operators.runs import (
    RUNS_SCHEMA, comparison, log_entries, logged_runs, put_log, valid_runs, write_runs_json, write_scaling_json,
)
from opinara.plans.loading import KEY, load_splits
from opinara.plans.models import load_model, save_model, score, weights_table
from opinara.plans.studies import FRACTIONS, PARALLEL, RunSpec, default_grid, run_grid, scaling_study, scaling_summary
from opinara.session import materialize
from opinara.settings import FeatureSettings, SourceSettings
from opinara.sources.reviews import check_count, conform, counted, read_parquet, write_reviews


def _write(tables: dict[str, DataFrame], out: str, mode: str = "errorifexists") -> dict[str, str]:
    paths = {name: f"{out}/{name}" for name in tables}
    for name, table in tables.items():
        table.write.mode(mode).parquet(paths[name])
    return paths


def conform_job(
    spark: SparkSession, source: str, out: str, fmt: str = "parquet", expected: int | None = None
) -> str:
    """Upstream layout to review layout, its rows counted as they are written.

    With another number than ``expected`` it raises; what has been written is then not to be used.
    """
    rows, seen = counted(conform(read_parquet(spark.newSession(), source)))
    path = write_reviews(rows, out, fmt)
    if expected is not None:
        check_count(seen.get["rows"], expected)
    return path


def profile_job(spark: SparkSession, sources: SourceSettings, out: str) -> dict[str, str]:
    """Every table of the data profile, from one pass over the texts of both splits."""
    train, test = load_splits(spark, sources)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    columns = ("char_length", "word_count", "title_len", "text_len")
    of_train = F.when(F.col("split") == "train", words.counted_words()).otherwise(F.array().cast("array<string>"))
    counts = profile.value_counts(with_lengths(both), {c: F.col(c) for c in columns}, ("split", "label"), of_train)
    lengths = counts.filter((F.col("split") == "train") & (F.col("series") != profile.TERMS))
    every = lengths.groupBy("series", "value").agg(F.sum("cnt").alias("cnt"))
    by_class = lengths.filter((F.col("series") == "word_count") & F.col("value").isNotNull())
    by_class = by_class.groupBy("label", clip(F.col("value"), 500).alias("value")).agg(F.sum("cnt").alias("cnt"))
    terms = counts.filter(F.col("series") == profile.TERMS).select("label", F.col("term").alias("word"), "cnt")

    def histogram(bins: int, **measures: tuple[str, int]) -> DataFrame:
        return profile.histogram_of_counts(profile.clipped(every, measures), bins)

    return _write(
        {
            "class_distribution": profile.class_distribution_of_counts(counts, "char_length"),
            "char_length": histogram(100, chars=("char_length", 3000)),
            "word_count": histogram(100, words=("word_count", 500)),
            "title_text": histogram(50, title=("title_len", 200), text=("text_len", 3000)),
            "density": profile.density_of_counts(by_class, "label"),
            "summary": profile.summary_of_counts(every),
            "word_weights": words.weights_of_top(words.top_of_counts(terms, words.CLOUD_WORDS)),
        },
        out,
    )


def evaluation_job(predictions: DataFrame, key: str, out: str, mode: str = "errorifexists") -> dict[str, str]:
    """Metrics, curves and error tables of one model's predictions."""
    # Read many times, so scored once; of the text only its length and its beginning are kept.
    text = F.col("combined_text")
    kept = materialize(
        predictions.select(
            key, "label", "prediction", "prob",
            F.length(text).alias("text_length"), preview(text).alias("preview"),
        )
    )
    ranked = materialize(curves.ranked_counts(kept))  # metrics and all curves come from it
    return _write(
        {
            "metrics": metrics.classification_metrics(kept, ranked=ranked),
            "confusion": metrics.confusion(kept),
            "roc": curves.roc_points(kept, ranked=ranked),
            "precision_recall": curves.pr_points(kept, ranked=ranked),
            "average_precision": curves.average_precision(kept, ranked=ranked),
            "overview": metrics.error_overview(kept),
            "accuracy_by_length": metrics.accuracy_by_length(kept, length="text_length"),
            "confidence": metrics.confidence_histogram(kept),
            "false_positives": errors.top_errors(kept, "fp", key, text="preview"),
            "false_negatives": errors.top_errors(kept, "fn", key, text="preview"),
        },
        out,
        mode,
    )


def train_job(
    spark: SparkSession, sources: SourceSettings, out: str,
    specs: Sequence[RunSpec] | None = None, overrides: dict[str, dict] | None = None, parallel: int = PARALLEL,
) -> dict[str, str]:
    """Run the grid, save and log every run as it ends, compare the runs, evaluate the best model.

    Started again with the same ``out``, a study goes on with the runs its log does not hold. Each run's
    model stays below ``out/models``; a run is logged after its model has been written.
    """
    specs, overrides = specs or default_grid(), overrides or {}
    train, test = load_splits(spark, sources)
    log_path = f"{out}/log"

    def name(spec: RunSpec) -> str:
        return spec.run_id(overrides.get(spec.model))

    def saved(spec: RunSpec) -> str:
        return f"{out}/models/{name(spec)}"

    def logged(spec: RunSpec, row: dict, artifacts: Sequence[str]) -> None:
        runs = valid_runs(spark.createDataFrame([row], RUNS_SCHEMA))
        put_log(log_entries(runs, spec.params(overrides.get(spec.model)), artifacts), log_path)

    def on_run(spec: RunSpec, row: dict, model: PipelineModel | None) -> None:
        if model is not None:
            logged(spec, row, [save_model(model, saved(spec))])

    known = logged_runs(spark, log_path, [name(spec) for spec in specs])
    result = run_grid(spark, train, test, specs, KEY, overrides, on_run, known, parallel)
    paths = {"runs": write_runs_json(result.runs, f"{out}/runs", mode="overwrite"), "log": log_path}
    failed = result.runs.filter(F.col("error").isNotNull()).select("seq", "model", "feature_type", "error")
    paths |= _write({"comparison": comparison(valid_runs(result.runs)), "failed": failed}, out, "overwrite")
    if result.best is not None:
        paths["model"] = saved(result.best)
        best = result.best_model or load_model(paths["model"])
        paths |= evaluation_job(score(best, test), KEY, f"{out}/evaluation", "overwrite")
        row = next(r for r in valid_runs(result.runs).collect() if specs[r.seq] == result.best).asDict()
        logged(result.best, row, [paths[part] for part in ("model", "metrics", "roc")])
    return paths


def error_job(spark: SparkSession, sources: SourceSettings, model: str, out: str) -> dict[str, str]:
    """Evaluate a saved model on the test split."""
    _, test = load_splits(spark, sources)
    return evaluation_job(score(load_model(model), test), KEY, out)


def scaling_job(
    spark: SparkSession, sources: SourceSettings, out: str, fractions: Sequence[float] = FRACTIONS,
    settings: FeatureSettings = FeatureSettings(),
) -> dict[str, str]:
    """The scaling study as a table and as JSON, and its summary."""
    train, test = load_splits(spark, sources)
    study = scaling_study(spark, train, test, KEY, fractions, settings=settings)
    paths = _write({"scaling": study, "scaling_summary": scaling_summary(study)}, out)
    return paths | {"scaling_json": write_scaling_json(study, f"{out}/scaling_json")}


def export_job(spark: SparkSession, model: str, out: str) -> dict[str, str]:
    """Weights of a saved linear model as a table."""
    return _write({"weights": weights_table(spark, load_model(model))}, out)
