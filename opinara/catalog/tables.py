"""The review tables behind the registered queries, built from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.functions.text import pieces, without_stop_words
from opinara.operators.metrics import classification_metrics
from opinara.operators.prep import drop_nulls, prepare, prepare_text, with_split
from opinara.operators.runs import RUNS_SCHEMA
from opinara.sources.reviews import read_reviews, spread

KEY = "doc_id"
RULE_CHARS, RULE_WORDS = 3000, 500
RULE_RUNS = ("long_text + characters", "long_text + words", "short_text + characters")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_reviews(spark, f"{sf_dir}/{name}.parquet")


def upstream_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents in the upstream layout: ``label`` 0/1, ``title``, ``content``."""
    labels = table(spark, sf_dir, "labels").select(KEY, F.col("quality").cast("bigint").alias("label"))
    return documents(spark, sf_dir).withColumnRenamed("text", "content").join(labels, KEY)


def documents(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Key, title and text of all documents; ``heavy`` prepares for costly text work."""
    scan = table(spark, sf_dir, "documents").select(KEY, F.col("source").alias("title"), "text")
    return spread(scan, KEY) if heavy else scan


def raw_reviews(
    spark: SparkSession, sf_dir: str, how: str = "inner", heavy: bool = False
) -> DataFrame:
    """Key, polarity, title and text; ``how="left"`` keeps unlabelled documents."""
    labels = table(spark, sf_dir, "labels").select(KEY, (F.col("quality") + 1).alias("polarity"))
    rows = documents(spark, sf_dir, heavy).join(labels, KEY, how)
    return rows.select(KEY, "polarity", "title", "text")


def reviews(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Prepared labelled reviews with their split."""
    return with_split(prepare(raw_reviews(spark, sf_dir, heavy=heavy)), KEY)


def train_and_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    whole = reviews(spark, sf_dir, heavy=True)
    return whole.filter(F.col("split") == "train"), whole.filter(F.col("split") == "test")


def articles(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """All documents, labelled or not, prepared."""
    return prepare_text(drop_nulls(documents(spark, sf_dir, heavy)))


def with_tokens(df: DataFrame) -> DataFrame:
    """Token columns of prepared text from plain expressions, equal to those of the ML stages."""
    return df.withColumn("tokens", pieces(F.col("combined_text"))).withColumn(
        "filtered_tokens", without_stop_words(F.col("tokens"))
    )


def rule_scores(df: DataFrame) -> DataFrame:
    """A prediction table that needs no fit: longer texts count as more positive."""
    share = F.least(F.length("text"), F.lit(RULE_CHARS)) / F.lit(float(RULE_CHARS))
    return df.withColumn("prob", share).withColumn(
        "prediction", F.when(F.col("prob") >= 0.5, 1.0).otherwise(0.0)
    )


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_scores(reviews(spark, sf_dir))


def partial_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule's predictions with scores from elsewhere, which only some of the reviews have."""
    texts = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias(KEY))
    scores = texts.agg((F.max("turn") / F.lit(10.0)).alias("prob"))
    return rule_predictions(spark, sf_dir).drop("prob").join(scores, KEY, "left")


def gapped_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule's predictions, kept for documents of an even source; scores from conversations, some NaN, some missing."""
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias(KEY)).agg(F.max("turn").alias("turns"))
    rows = rule_predictions(spark, sf_dir).drop("prob").join(turns, KEY, "left")
    score = F.when(F.col("turns") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("turns") / F.lit(10.0))
    kept = F.when(F.right("title", F.lit(1)).isin(*"02468"), F.col("prediction"))
    return rows.withColumn("prob", score).withColumn("prediction", kept).drop("turns")


def rule_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A runs table of three rules, evaluated side by side in one pass over the reviews."""
    chars = F.least(F.length("text"), F.lit(RULE_CHARS)) / F.lit(float(RULE_CHARS))
    words = F.least(F.size(F.split("text", " ")), F.lit(RULE_WORDS)) / F.lit(float(RULE_WORDS))
    scores = (chars, words, 1.0 - chars)
    rules = [
        F.struct(
            F.lit(seq).alias("seq"),
            *[F.lit(part).alias(c) for c, part in zip(("model", "feature_type"), run.split(" + "))],
            score.alias("prob"),
        )
        for seq, (run, score) in enumerate(zip(RULE_RUNS, scores, strict=True))
    ]
    scored = reviews(spark, sf_dir).select("label", F.inline(F.array(*rules)))
    scored = scored.withColumn("prediction", F.when(F.col("prob") >= 0.5, 1.0).otherwise(0.0))
    runs = classification_metrics(scored, by=("seq", "model", "feature_type"))
    # A rule is not trained.
    runs = runs.withColumn("training_time", F.lit(0.0)).withColumn("error", F.lit(None).cast("string"))
    return runs.select(*RUNS_SCHEMA.names)
