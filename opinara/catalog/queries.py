"""Registered queries: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.catalog.tables import (
    KEY, RULE_RUNS, articles, gapped_predictions, partial_predictions, raw_reviews, reviews, rule_predictions, rule_runs, table,
    train_and_test, upstream_reviews, with_tokens,
)
from opinara.functions.predictions import confidence, verdict
from opinara.functions.text import ngrams
from opinara.operators import (
    curves, errors, metrics as evaluation, prep, profile, runs as run_tables, sampling, weights,
    words,
)
from opinara.operators.vocabulary import term_counts, tfidf, vocabulary
from opinara.plans import studies
from opinara.plans.features import FEATURES, HASHED, text_stages, weighting_stages
from opinara.plans.models import full_pipeline, load_model, save_model, score, weights_table
from opinara.session import fresh_path
from opinara.settings import FeatureSettings
from opinara.sources import reviews as sources
from opinara.streaming.scoring import BATCH, COUNTS, REJECTED, VERDICTS, read_sink, review_stream, score_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STATES = 1024  # partial feature summaries, one for so many tasks at most
SAMPLE_FRACTION, SAMPLE_ROWS, SAMPLE_PER_CLASS = 0.1, 250, 40
# Terms and weights of a hand-made linear model, and its intercept.
DEMO_WEIGHTS = {"de": 0.02, "la": -0.015, "the.": 0.05, "der": -0.1, "que": 0.075, "orre": -0.03}
DEMO_INTERCEPT = -0.25


def query(function: Query) -> Query:
    """Register under the function's name, less the trailing ``_`` that avoids a clash."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _listed(row: DataFrame, kind: str) -> DataFrame:
    """The columns of one row as ``measure, value``."""
    return row.select(*[F.col(c).cast(kind) for c in row.columns]).unpivot([], row.columns, "measure", "value")


# Sources and sinks


@query
def scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(KEY, F.col("source").alias("title"), "text")


@query
def scan_csv(spark, sf_dir):
    path = fresh_path(spark, "reviews-csv")
    sources.write_reviews(raw_reviews(spark, sf_dir).drop(KEY), path, "csv")
    return sources.read_reviews(spark, path, fmt="csv")


@query
def conform_schema(spark, sf_dir):
    return sources.conform(upstream_reviews(spark, sf_dir))


@query
def sink_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "reviews") + ".parquet"
    sources.write_reviews(raw_reviews(spark, sf_dir), path)
    return sources.read_reviews(spark, path)


@query
def null_drop_counts(spark, sf_dir):
    return sources.null_drop_counts(raw_reviews(spark, sf_dir, how="left"))


@query
def preview_rows(spark, sf_dir):
    return sources.first_rows(raw_reviews(spark, sf_dir), KEY)


# Projections and filters


@query
def prep_reviews(spark, sf_dir):
    return reviews(spark, sf_dir).select(KEY, "title", "combined_text", "label", "split")


@query
def label_map(spark, sf_dir):
    """Quality and toxicity added up give a polarity of 1, 2 or the unexpected 3."""
    polarity = F.col("quality") + F.col("toxic") + 1
    labelled = table(spark, sf_dir, "labels").select(polarity.alias("polarity"))
    return (
        labelled.withColumn("label", prep.label_of(F.col("polarity")))
        .groupBy("polarity", "label")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


@query
def correct_flag(spark, sf_dir):
    return evaluation.correct_flags(rule_predictions(spark, sf_dir)).select(KEY, "is_correct")


@query
def text_lengths(spark, sf_dir):
    lengths = ("char_length", "word_count", "title_len", "text_len")
    return prep.with_lengths(articles(spark, sf_dir)).select(KEY, *lengths)


@query
def score_input_guard(spark, sf_dir):
    guarded = prep.guarded_input(table(spark, sf_dir, "conversations"))
    return guarded.select("conv_id", "turn", "model_input")


@query
def verdict_(spark, sf_dir):
    return rule_predictions(spark, sf_dir).select(
        KEY,
        verdict(F.col("prediction")).alias("sentiment"),
        F.round(confidence(F.col("prob")), 6).alias("confidence"),
    )


# Sampling and splitting


@query
def sample_fraction(spark, sf_dir):
    return sampling.hash_sample(articles(spark, sf_dir), KEY, SAMPLE_FRACTION).select(KEY, "title")


@query
def sample_exact(spark, sf_dir):
    return sampling.sample_n(articles(spark, sf_dir).select(KEY, "title"), KEY, SAMPLE_ROWS)


@query
def sample_per_class(spark, sf_dir):
    return sampling.sample_per_class(reviews(spark, sf_dir).select(KEY, "label"), KEY, SAMPLE_PER_CLASS)


@query
def stratified_split(spark, sf_dir):
    return sampling.stratified_split(reviews(spark, sf_dir).select(KEY, "label"), KEY)


@query
def sample_per_class_turns(spark, sf_dir):
    """Classes and keys as they come: a conversation has many turns, so its key repeats, and all roles are classes."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    picked = sampling.sample_per_class(turns, "conv_id", SAMPLE_PER_CLASS, label="role")
    return picked.groupBy("role").agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("conv_id").alias("conversations"))


# Data profile


@query
def split_counts(spark, sf_dir):
    return profile.split_counts(reviews(spark, sf_dir))


@query
def class_distribution(spark, sf_dir):
    return profile.class_distribution(reviews(spark, sf_dir))


@query
def hist_char_length(spark, sf_dir):
    measured = prep.with_lengths(articles(spark, sf_dir))
    return profile.length_histogram(measured, {"char_length": ("char_length", 3000)}, 100)


@query
def hist_word_count(spark, sf_dir):
    measured = prep.with_lengths(articles(spark, sf_dir))
    return profile.length_histogram(measured, {"word_count": ("word_count", 500)}, 100)


@query
def hist_title_text(spark, sf_dir):
    measures = {"title": ("title_len", 200), "text": ("text_len", 3000)}
    return profile.length_histogram(prep.with_lengths(articles(spark, sf_dir)), measures, 50)


@query
def length_density(spark, sf_dir):
    return profile.density(prep.with_lengths(reviews(spark, sf_dir)), "word_count", 500, "label")


@query
def top_words_by_class(spark, sf_dir):
    return words.top_words(reviews(spark, sf_dir, heavy=True))


@query
def word_weights(spark, sf_dir):
    return rounded(words.word_weights(reviews(spark, sf_dir, heavy=True)), "weight")


@query
def length_summary(spark, sf_dir):
    measures = {name: name for name in ("char_length", "word_count", "title_len", "text_len")}
    return profile.summary(prep.with_lengths(articles(spark, sf_dir)), measures)


# Evaluation


@query
def metrics(spark, sf_dir):
    measured = evaluation.classification_metrics(rule_predictions(spark, sf_dir))
    return rounded(measured, *run_tables.METRICS)


@query
def auc_exact(spark, sf_dir):
    return rounded(curves.auc(rule_predictions(spark, sf_dir)), "auc")


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion(rule_predictions(spark, sf_dir))


@query
def roc_points(spark, sf_dir):
    return rounded(curves.roc_points(rule_predictions(spark, sf_dir)), "threshold", "fpr", "tpr")


@query
def metrics_partly_scored(spark, sf_dir):
    measured = evaluation.classification_metrics(partial_predictions(spark, sf_dir))
    return rounded(measured, *run_tables.METRICS)


@query
def roc_partly_scored(spark, sf_dir):
    return rounded(curves.roc_points(partial_predictions(spark, sf_dir)), "threshold", "fpr", "tpr")


@query
def pr_points(spark, sf_dir):
    points = curves.pr_points(rule_predictions(spark, sf_dir))
    return rounded(points, "threshold", "precision", "recall")


@query
def average_precision(spark, sf_dir):
    return rounded(curves.average_precision(rule_predictions(spark, sf_dir)), "average_precision")


@query
def error_overview(spark, sf_dir):
    overview = evaluation.error_overview(rule_predictions(spark, sf_dir))
    return rounded(overview, "correct_pct", "incorrect_pct")


@query
def accuracy_by_length(spark, sf_dir):
    return rounded(evaluation.accuracy_by_length(rule_predictions(spark, sf_dir)), "accuracy")


@query
def confidence_hist(spark, sf_dir):
    return evaluation.confidence_histogram(rule_predictions(spark, sf_dir))


@query
def top_false_positives(spark, sf_dir):
    return rounded(errors.top_errors(rule_predictions(spark, sf_dir), "fp", KEY), "confidence")


@query
def top_false_negatives(spark, sf_dir):
    return rounded(errors.top_errors(rule_predictions(spark, sf_dir), "fn", KEY), "confidence")


@query
def confusion_gaps(spark, sf_dir):
    return evaluation.confusion(gapped_predictions(spark, sf_dir))


@query
def metrics_gaps(spark, sf_dir):
    """Metrics and overview of one table whose predictions and scores are partly missing: both count the same rows."""
    rows = gapped_predictions(spark, sf_dir)
    measured = evaluation.classification_metrics(rows).drop("auc")
    return rounded(_listed(measured, "double").unionByName(_listed(evaluation.error_overview(rows), "double")), "value")


@query
def confidence_hist_gaps(spark, sf_dir):
    return evaluation.confidence_histogram(gapped_predictions(spark, sf_dir))


@query
def top_errors_gaps(spark, sf_dir):
    """Both kinds, each with its rows that have no score at the end."""
    rows = gapped_predictions(spark, sf_dir).withColumn("prob", F.col("prob").cast("double"))
    kinds = [errors.top_errors(rows, kind, KEY).withColumn("kind", F.lit(kind)) for kind in ("fp", "fn")]
    return rounded(kinds[0].unionByName(kinds[1]), "confidence")


# Features


@query
def tokens(spark, sf_dir):
    split = PipelineModel(stages=text_stages()).transform(articles(spark, sf_dir, heavy=True))
    return split.select(
        KEY, F.size("tokens").alias("n_tokens"), F.array_join("tokens", "|").alias("tokens")
    )


@query
def tokens_filtered(spark, sf_dir):
    split = PipelineModel(stages=text_stages()).transform(articles(spark, sf_dir, heavy=True))
    kept = F.col("filtered_tokens")
    return split.select(KEY, F.size(kept).alias("n_tokens"), F.array_join(kept, "|").alias("tokens"))


@query
def bigrams(spark, sf_dir):
    split = with_tokens(articles(spark, sf_dir, heavy=True))
    return split.select(
        KEY, F.array_join(ngrams(F.col("filtered_tokens")), "|").alias("bigrams")
    )


@query
def vocabulary_(spark, sf_dir):
    return vocabulary(with_tokens(articles(spark, sf_dir, heavy=True)))


@query
def bigram_vocabulary(spark, sf_dir):
    return vocabulary(with_tokens(articles(spark, sf_dir, heavy=True)), ngrams(F.col("filtered_tokens")))


@query
def term_counts_(spark, sf_dir):
    return term_counts(with_tokens(articles(spark, sf_dir, heavy=True)), KEY)


@query
def tfidf_terms(spark, sf_dir):
    return rounded(tfidf(with_tokens(articles(spark, sf_dir, heavy=True)), KEY), "tfidf")


def _slots(vectors: DataFrame, column: str) -> DataFrame:
    """Mean and non-zero entries per feature slot.

    Two levels: a dense state per group of tasks first, then the groups' slots apart, so that the
    states of all tasks never meet in one.
    """
    summary = Summarizer.metrics("sum", "numNonZeros", "count").summary(F.col(column))
    states = vectors.groupBy((F.spark_partition_id() % STATES).alias("state")).agg(summary.alias("s"))
    totals, filled = (vector_to_array(F.col(f"s.{name}")) for name in ("sum", "numNonZeros"))
    slots = states.select(F.col("s.count").alias("n"), F.posexplode(F.arrays_zip(totals.alias("sum"), filled.alias("docs"))))
    rows = states.agg(F.sum("s.count")).scalar()
    merged = slots.groupBy(F.col("pos").alias("slot")).agg(
        (F.sum("col.sum") / rows).alias("mean"), F.sum("col.docs").cast("bigint").alias("docs")
    )
    return merged.filter(F.col("docs") > 0)


@query
def hashed_tf(spark, sf_dir):
    """Counts in hashed slots add up to the number of tokens, whatever the hash."""
    text = PipelineModel(stages=text_stages()).transform(articles(spark, sf_dir, heavy=True))
    hashing = weighting_stages("tfidf")[0]
    total = Summarizer.metrics("sum").summary(F.col(HASHED))
    states = hashing.transform(text).groupBy((F.spark_partition_id() % STATES).alias("state"))
    summed = states.agg(F.count(F.lit(1)).alias("n_docs"), total.alias("s"))
    added = F.aggregate(vector_to_array(F.col("s.sum")), F.lit(0.0), lambda a, b: a + b)
    return summed.select("n_docs", added.alias("tf")).agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum("tf"), F.lit(0.0)).cast("bigint").alias("total_tf"),
    )


def _fitted_features(spark, sf_dir, feature_type) -> DataFrame:
    vectors = PipelineModel(stages=text_stages()).transform(articles(spark, sf_dir, heavy=True))
    for stage in weighting_stages(feature_type):
        stage = stage.fit(vectors) if hasattr(stage, "fit") else stage
        vectors = stage.transform(vectors)
    return _slots(vectors, FEATURES)


@query
def features_count_vectorizer(spark, sf_dir):
    return rounded(_fitted_features(spark, sf_dir, "count_vectorizer"), "mean")


@query
def features_ngram_cv(spark, sf_dir):
    return rounded(_fitted_features(spark, sf_dir, "ngram_cv"), "mean")


@query
def features_tfidf(spark, sf_dir):
    return _fitted_features(spark, sf_dir, "tfidf")


@query
def features_ngram_tfidf(spark, sf_dir):
    return _fitted_features(spark, sf_dir, "ngram_tfidf")


# Models


def _fit(spark, sf_dir, model, feature_type="count_vectorizer", **overrides):
    train, _ = train_and_test(spark, sf_dir)
    train = prep.keep(train.select("label", "combined_text"))
    fitted = full_pipeline(feature_type, model, FeatureSettings(), **overrides).fit(train)
    prep.release(train)
    return fitted


def _trained_metrics(spark, sf_dir, model):
    _, test = train_and_test(spark, sf_dir)
    predictions = score(_fit(spark, sf_dir, model), test, KEY, "label")
    return rounded(evaluation.classification_metrics(predictions), *run_tables.METRICS)


@query
def train_nb(spark, sf_dir):
    return _trained_metrics(spark, sf_dir, "naive_bayes")


@query
def train_lr(spark, sf_dir):
    return _trained_metrics(spark, sf_dir, "logistic_regression")


@query
def train_rf(spark, sf_dir):
    return _trained_metrics(spark, sf_dir, "random_forest")


@query
def train_gbt(spark, sf_dir):
    return _trained_metrics(spark, sf_dir, "gbt")


@query
def score_batch(spark, sf_dir):
    model = _fit(spark, sf_dir, "naive_bayes")
    return rounded(score(model, reviews(spark, sf_dir, heavy=True), KEY, "label"), "prob")


@query
def model_roundtrip(spark, sf_dir):
    path = save_model(_fit(spark, sf_dir, "naive_bayes"), fresh_path(spark, "model"))
    return rounded(score(load_model(path), reviews(spark, sf_dir, heavy=True), KEY, "label"), "prob")


@query
def nb_accuracy_by_length(spark, sf_dir):
    """Fit, score and break down: the whole way from raw tables to the error analysis."""
    predictions = score(
        _fit(spark, sf_dir, "naive_bayes"), reviews(spark, sf_dir, heavy=True), "label", "combined_text"
    )
    return rounded(evaluation.accuracy_by_length(predictions), "accuracy")


@query
def nb_weights(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    fitted = weights.naive_bayes_weights(with_tokens(train))
    return rounded(fitted, "theta", "pi")


@query
def nb_predict(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    margin = weights.naive_bayes_margin(weights.naive_bayes_weights(with_tokens(train)))
    scored = weights.score_with_weights(
        with_tokens(reviews(spark, sf_dir, heavy=True)), margin, KEY, carry=("label",)
    )
    return rounded(scored.select(KEY, "label", "prediction", "prob"), "prob")


@query
def weights_table_(spark, sf_dir):
    return weights_table(spark, _fit(spark, sf_dir, "logistic_regression"))


@query
def score_with_weights(spark, sf_dir):
    demo = weights.weights_of(
        spark, list(DEMO_WEIGHTS), list(DEMO_WEIGHTS.values()), DEMO_INTERCEPT
    )
    docs = with_tokens(articles(spark, sf_dir, heavy=True))
    scored = weights.score_with_weights(docs, demo, KEY)
    return rounded(scored, "margin", "prob")


# Studies and run tables


@query
def run_grid(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return studies.run_grid(spark, train, test, studies.default_grid(), KEY).runs


@query
def grid_nb(spark, sf_dir):
    """The two runs of a grid that have a closed form, logged as they end; the study then goes on from its log."""
    train, test = train_and_test(spark, sf_dir)
    specs = [studies.RunSpec("naive_bayes", features) for features in ("count_vectorizer", "ngram_cv")]
    path = fresh_path(spark, "grid-log")

    def on_run(spec, row, model):
        entry = run_tables.valid_runs(spark.createDataFrame([row], run_tables.RUNS_SCHEMA))
        run_tables.put_log(run_tables.log_entries(entry, spec.params()), path)

    studies.run_grid(spark, train, test, specs, KEY, on_run=on_run)
    logged = run_tables.logged_runs(spark, path, [spec.run_id() for spec in specs])
    result = studies.run_grid(spark, train, test, specs, KEY, logged=logged)
    best = F.lit(result.best.feature_type) == F.col("feature_type")
    return rounded(result.runs.select("seq", "model", "feature_type", *run_tables.METRICS, best.alias("is_best")), *run_tables.METRICS)


@query
def scaling_study(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return studies.scaling_study(spark, train, test, KEY)


@query
def scaling_nb(spark, sf_dir):
    """Sizes and accuracies of the scaling study with the model that has a closed form.

    Accuracy is null where the sample has no vocabulary or nothing is tested; a fraction that fails ends the query.
    """
    train, test = train_and_test(spark, sf_dir)
    study = studies.scaling_study(spark, train, test, KEY, model="naive_bayes", failures=studies.SMALL)
    return rounded(study.select("fraction", "n_rows", "accuracy"), "accuracy")


@query
def scaling_summary(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    study = studies.scaling_study(spark, train, test, KEY, model="naive_bayes", failures=studies.SMALL)
    return studies.scaling_summary(study)


@query
def best_run(spark, sf_dir):
    best = run_tables.best_run(rule_runs(spark, sf_dir))
    return rounded(best.select("seq", "model", "feature_type", "accuracy"), "accuracy")


@query
def run_comparison(spark, sf_dir):
    runs = rule_runs(spark, sf_dir)
    return run_tables.comparison(rounded(runs, *run_tables.METRICS, digits=9))


@query
def run_comparison_long(spark, sf_dir):
    return rounded(run_tables.comparison_series(rule_runs(spark, sf_dir)), "value")


@query
def run_pivot(spark, sf_dir):
    return rounded(run_tables.metric_table(rule_runs(spark, sf_dir), RULE_RUNS), *RULE_RUNS)


@query
def runs_json(spark, sf_dir):
    path = run_tables.write_runs_json(rule_runs(spark, sf_dir), fresh_path(spark, "runs-json"))
    read = run_tables.read_runs_json(spark, path)
    return rounded(read.select("seq", "model", "feature_type", *run_tables.METRICS), *run_tables.METRICS)


@query
def run_log(spark, sf_dir):
    path = fresh_path(spark, "runs-log")
    entries = run_tables.log_entries(rule_runs(spark, sf_dir), {"max_chars": 3000})
    # Run by run, and all of them again: each stays one entry.
    for seq in range(len(RULE_RUNS)):
        run_tables.put_log(run_tables.log_entries(rule_runs(spark, sf_dir).filter(F.col("seq") == seq), {"max_chars": 3000}), path)
    run_tables.put_log(entries, path)
    logged = run_tables.read_log(spark, path)
    return logged.select(
        "run_name",
        F.col("params")["model_name"].alias("model_name"),
        F.col("params")["max_chars"].alias("max_chars"),
        F.explode("metrics").alias("metric", "value"),
    ).select("run_name", "model_name", "max_chars", "metric", F.round("value", 6).alias("value"))


# Streaming


@query
def score_stream_(spark, sf_dir):
    """The stream reads every document; its written verdicts are read back."""
    model = _fit(spark, sf_dir, "naive_bayes")
    schema = table(spark, sf_dir, "documents").schema
    stream = review_stream(spark, f"{sf_dir}/documents*.parquet", schema)
    sink = fresh_path(spark, "verdicts")
    score_stream(stream, model, KEY, sink, fresh_path(spark, "progress")).awaitTermination()
    return rounded(read_sink(spark, sink).drop(BATCH), "prob", "confidence")


@query
def stream_counts(spark, sf_dir):
    """What the stream read, scored and rejected; every seventh document loses its text on the way in."""
    model = _fit(spark, sf_dir, "naive_bayes")
    stream = review_stream(spark, f"{sf_dir}/documents*.parquet", table(spark, sf_dir, "documents").schema)
    text = F.when(F.col(KEY) % 7 > 1, F.col("text")).when(F.col(KEY) % 7 == 1, " \n")
    sink = fresh_path(spark, "verdicts")
    score_stream(stream.withColumn("text", text), model, KEY, sink, fresh_path(spark, "progress")).awaitTermination()
    sums = [F.sum(c).alias(c) for c in ("n_read", "n_scored", "n_rejected")]
    written = [read_sink(spark, sink, name).select(F.lit(name).alias("name")) for name in (VERDICTS, REJECTED)]
    rows = written[0].unionByName(written[1]).agg(*[F.count_if(F.col("name") == n).alias(f"rows_{n}") for n in (VERDICTS, REJECTED)])
    return _listed(read_sink(spark, sink, COUNTS).agg(*sums), "long").unionByName(_listed(rows, "long"))
