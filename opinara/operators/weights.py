"""Linear models as tables: naive Bayes in closed form, and scoring from weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from opinara.operators.vocabulary import BROADCAST_TERMS, most_frequent, small, term_stats
from opinara.session import materialize
from opinara.settings import FeatureSettings

WEIGHTS_SCHEMA = StructType(
    [
        StructField("idx", IntegerType()),
        StructField("term", StringType()),
        StructField("weight", DoubleType()),
    ]
)
INTERCEPT = -1
CLASSES = (0.0, 1.0)


def naive_bayes_weights(
    df: DataFrame, pieces: str = "filtered_tokens", label: str = "label",
    settings: FeatureSettings = FeatureSettings(), smoothing: float = 1.0,
) -> DataFrame:
    """Log prior ``pi`` and log likelihood ``theta`` per class and vocabulary term.

    A fit, so it runs at once: the texts are read once for the terms, whose counts are written out
    and serve both the choice of the vocabulary and its counts per class, and once for the priors.
    The result, two rows per vocabulary term, is written to the shared folder.
    """
    terms = term_stats(df, pieces, label, CLASSES).filter(F.col("df") >= F.lit(settings.min_df))
    terms = materialize(terms)
    known = most_frequent(terms, settings.vocab_size)
    per_class = F.array(
        *[
            F.struct(F.lit(c).alias("label"), F.col(f"cnt_{i}").alias("tf"))
            for i, c in enumerate(CLASSES)
        ]
    )
    cells = known.select("idx", "term", F.inline(per_class))
    whole = Window.partitionBy("label")
    total = F.sum("tf").over(whole) + smoothing * F.count(F.lit(1)).over(whole)
    theta = F.log(F.col("tf") + smoothing) - F.log(total)

    rows = [F.count(F.when(F.col(label) == c, 1)) for c in CLASSES]
    everything = F.log(sum(rows[1:], rows[0]) + smoothing * len(CLASSES))
    priors = df.agg(F.array(*[F.log(n + smoothing) - everything for n in rows]).alias("pi"))
    pi = F.get(priors.scalar(), F.col("label").cast("int"))
    return materialize(
        cells.select("label", "idx", "term", "tf", theta.alias("theta"), pi.alias("pi"))
    )


def naive_bayes_margin(weights: DataFrame) -> DataFrame:
    """The two classes' logs as one weight per term plus an intercept row."""
    sign = F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
    terms = weights.groupBy("idx", "term").agg(F.sum(sign * F.col("theta")).alias("weight"))
    if weights.isEmpty():
        raise ValueError("No term in the vocabulary; lower min_df or give more text")
    intercept = weights.filter(F.col("idx") == 0).agg(
        F.lit(INTERCEPT).alias("idx"),
        F.lit(None).cast("string").alias("term"),
        F.sum(sign * F.col("pi")).alias("weight"),
    )
    return terms.unionByName(intercept)


def weights_of(spark: SparkSession, terms: list[str], weights: list[float], intercept: float) -> DataFrame:
    """A weights table from a vocabulary on the driver (at most the vocabulary size)."""
    rows = [(INTERCEPT, None, float(intercept))]
    rows += [(i, term, float(w)) for i, (term, w) in enumerate(zip(terms, weights, strict=True))]
    return spark.createDataFrame(rows, WEIGHTS_SCHEMA)


def score_with_weights(
    docs: DataFrame, weights: DataFrame, key: str, pieces: Column | str = "filtered_tokens",
    terms: int | None = None, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Margin and positive probability of each document under a weights table.

    The weights are counted unless ``terms`` says how many there are: up to the broadcast limit no token is
    shuffled, and only one partial sum per document and task is. ``key`` must be unique; ``carry`` names
    columns to keep.
    """
    pieces = F.col(pieces) if isinstance(pieces, str) else pieces
    intercept = weights.filter(F.col("idx") == INTERCEPT).agg(F.first("weight").alias("w")).scalar()
    lookup = weights.filter(F.col("idx") != INTERCEPT).select("term", "weight")
    terms = lookup.count() if terms is None else terms
    # explode_outer keeps documents without tokens, the left join those without known terms.
    scored = (
        docs.select(key, *carry, F.explode_outer(pieces).alias("term"))
        .join(small(lookup, terms, BROADCAST_TERMS), "term", "left")
        .groupBy(key, *carry)
        .agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("evidence"))
    )
    return scored.select(
        key, *carry, (F.col("evidence") + intercept).alias("margin")
    ).select(
        key,
        *carry,
        "margin",
        (1.0 / (1.0 + F.exp(-F.col("margin")))).alias("prob"),
        F.when(F.col("margin") > 0, 1.0).otherwise(0.0).alias("prediction"),
    )
