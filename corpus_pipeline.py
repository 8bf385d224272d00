"""From raw documents to token ids: each stage takes what the one before it kept.

Toxic documents go, one document of each group of near-duplicates stays, personal data are masked, the
sources are brought into mixed order, and every text is encoded. All stages but the last return
the columns of ``documents``. Each stage's result is a table of the shared folder.

Defined results: a null text stays null and encodes to no tokens; empty texts, null keys and null
sources stay; rows that agree in key and text are near copies, of which one stays; an empty table gives
an empty result. A further column travels with its row as far as the last stage, also one that is
called like a column the operators make.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.llm import bpe, jaccard, mixing, pii, toxicity
from opinara.llm.frames import store

VOCABULARY = "word_bpe_49k.json"
# No SQL can express the stages that learn or tokenize; tests hold run() against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier, fitted on the labelled ones among them, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shared word 5-grams, at a similarity of 0.8 or more."""
    return jaccard.keep_first(docs, size=5, percent=80)


def hide_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data; ``n_chars`` follows the text."""
    return pii.mask_pii(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in an order that holds the sources' target shares from the start."""
    return mixing.in_mixed_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("pii", hide_pii),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)  # each stage reads its input several times
    return STAGES[-1][1](spark, docs, sf_dir)
