"""Registered queries: each operator over its whole table, with the parameters it would run with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.llm import (
    bpe, jaccard, line_dedup, lm_scoring, merkle, mixing, pii, quality, sharding, suffix_dedup, topk, toxicity, variants,
)
from opinara.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VOCABULARY = "word_bpe_49k.json"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op2_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op4_extendible_shards(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@query
def op5_find_pii(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query
def op6_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op9_cut_repeated_lines(spark, sf_dir):
    cut = line_dedup.cut_repeated_units(table(spark, sf_dir, "documents"))
    return cut.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op8_jaccard_join(spark, sf_dir):
    return jaccard.join_components(table(spark, sf_dir, "documents"))


@query
def op7_suffix_array_dedup(spark, sf_dir):
    cut = suffix_dedup.cut_repeated_bytes(table(spark, sf_dir, "documents"))
    return cut.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept", "spans")


@query
def op10_quality_rules(spark, sf_dir):
    return quality.apply_rules(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (toxicity.fold("doc_id") == 0).alias("held_out"), "score", "predicted")


@query
def op3_top_k_search(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("lang", "path")


@query
def op13_lm_scoring(spark, sf_dir):
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark, sf_dir):
    return variants.variant_groups(table(spark, sf_dir, "documents"))
