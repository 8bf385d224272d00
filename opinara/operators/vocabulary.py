"""Term statistics: vocabulary, term counts and TF-IDF as relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinara.session import write_once
from opinara.settings import FeatureSettings

DEFAULTS = FeatureSettings()
# Up to this many vocabulary rows (a few MB) the vocabulary is broadcast, beyond it joined.
BROADCAST_TERMS = 1 << 18


def term_stats(
    df: DataFrame, pieces: Column | str, by: str | None = None, levels: tuple = (), documents: bool = False
) -> DataFrame:
    """Occurrences ``cnt`` and documents ``df`` per term, and ``cnt_<i>`` per level of ``by``.

    All come from one scan: every occurrence and every first occurrence is emitted, and the
    sums are combined per task, so frequent terms do not burden a single reducer. With ``documents`` each
    document also counts once for the null term, whose ``df`` is then the number of documents.
    """
    pieces = F.col(pieces) if isinstance(pieces, str) else pieces
    kept = [F.col(by).alias("level")] if by else []
    # Its own projection, so that the array is computed once for both uses below.
    rows = df.select(pieces.alias("pieces"), *kept)

    # A null is no term; a document without an array is one without terms.
    known = F.coalesce(F.filter("pieces", lambda term: term.isNotNull()), F.array().cast("array<string>"))
    rows = rows.withColumn("pieces", known)
    # All occurrences, then the first ones: where a piece stands tells which it is, with no struct made for it.
    parts = ["pieces", F.array_distinct("pieces")] + ([F.array(F.lit(None).cast("string"))] if documents else [])
    emitted = rows.select(*(["level"] if by else []), F.size("pieces").alias("n"), F.posexplode(F.concat(*parts)).alias("at", "term"))
    again = F.col("at") < F.col("n")
    emitted = emitted.select(*(["level"] if by else []), "term", again.cast("long").alias("cnt"), (~again).cast("long").alias("df"))
    per_level = [
        F.sum(F.when(F.col("level") == level, F.col("cnt")).otherwise(0)).alias(f"cnt_{i}")
        for i, level in enumerate(levels)
    ]
    return emitted.groupBy("term").agg(F.sum("cnt").alias("cnt"), F.sum("df").alias("df"), *per_level)


def _magnitude(count: Column) -> Column:
    """Sixteenths of powers of two: about a thousand levels for any count."""
    return F.floor(F.log2(count) * 16)


def most_frequent(terms: DataFrame, size: int) -> DataFrame:
    """The ``size`` terms with most occurrences, ties in term order, numbered from 0.

    A count of terms per magnitude tells which magnitudes can hold the top ``size``, so only
    little more than ``size`` rows reach the final sort instead of ``size`` per task.
    """
    down = Window.orderBy(F.desc("level"))
    levels = (
        terms.groupBy(_magnitude(F.col("cnt")).alias("level"))
        .agg(F.count(F.lit(1)).alias("terms"))
        .withColumn("upto", F.sum("terms").over(down))
    )
    floor = levels.filter(F.col("upto") >= size).agg(F.max("level").alias("level")).scalar()
    top = (
        terms.filter(_magnitude(F.col("cnt")) >= F.coalesce(floor, F.lit(0)))
        .orderBy(F.desc("cnt"), "term")
        .limit(size)
    )
    number = F.row_number().over(Window.orderBy(F.desc("cnt"), "term")) - 1
    return top.select(number.alias("idx"), *terms.columns)


def vocabulary(
    df: DataFrame, pieces: Column | str = "filtered_tokens",
    size: int = DEFAULTS.vocab_size, min_df: float = DEFAULTS.min_df,
) -> DataFrame:
    """Terms in at least ``min_df`` documents (a share of them if below 1), most frequent first.

    The counts are written out: the levels and the terms above them are both read from there, not from the texts.
    """
    return _vocabulary(write_once(term_stats(df, pieces, documents=True), "terms"), size, min_df)


def _documents(stats: DataFrame) -> Column:
    """Number of documents, from the row of the null term; 0 of an empty table."""
    return F.coalesce(stats.filter(F.col("term").isNull()).agg(F.max("df")).scalar(), F.lit(0))


def _vocabulary(stats: DataFrame, size: int, min_df: float) -> DataFrame:
    least = F.lit(min_df) if min_df >= 1 else F.lit(min_df) * _documents(stats)
    return most_frequent(stats.filter(F.col("term").isNotNull() & (F.col("df") >= least)), size)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_TERMS) -> DataFrame:
    """Mark ``df`` for broadcast if its known bound of ``rows`` is small enough."""
    return F.broadcast(df) if rows <= limit else df


def _known_occurrences(df: DataFrame, key: str, pieces: str, known: DataFrame, size: int) -> DataFrame:
    """One row per occurrence of a vocabulary term.

    The outer explode spares the optimizer's filter on the array's size, for which a computed
    array would be computed again; the join drops the empty documents' NULL.
    """
    occurrences = df.select(key, F.explode_outer(pieces).alias("term"))
    return occurrences.join(small(known, size), "term")


def term_counts(
    df: DataFrame, key: str, pieces: str = "filtered_tokens",
    size: int = DEFAULTS.vocab_size, min_df: float = DEFAULTS.min_df,
) -> DataFrame:
    """Occurrences of each vocabulary term per document, the sparse count vector as rows."""
    known = vocabulary(df, pieces, size, min_df).select("term", "idx")
    return (
        _known_occurrences(df, key, pieces, known, size)
        .groupBy(key, "idx", "term")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def tfidf(
    df: DataFrame, key: str, pieces: str = "filtered_tokens",
    size: int = DEFAULTS.vocab_size, min_df: float = DEFAULTS.min_df,
) -> DataFrame:
    """Term frequency times ``ln((documents + 1) / (documents with the term + 1))``.

    The texts are read twice: once for the terms' and the documents' numbers, which are written out, and
    once for the occurrences.
    """
    stats = write_once(term_stats(df, pieces, documents=True), "terms")
    known = write_once(_vocabulary(stats, size, min_df).select("term", "idx", "df"), "vocabulary")
    # Counted by number; the terms themselves come back to the counts and are not shuffled with them.
    counted = (
        _known_occurrences(df, key, pieces, known.select("term", "idx"), size)
        .groupBy(key, "idx")
        .agg(F.count(F.lit(1)).alias("tf"))
        .join(small(known, size), "idx")
    )
    inverse = F.log((_documents(stats).cast("double") + 1) / (F.col("df") + 1))
    return counted.select(key, "idx", "term", "tf", "df", (F.col("tf") * inverse).alias("tfidf"))
