"""Feature pipelines: text stages shared by all, then one of two weightings."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    IDF, CountVectorizer, CountVectorizerModel, HashingTF, NGram, StopWordsRemover, Tokenizer,
)
from pyspark.sql import DataFrame, SparkSession

from opinara.operators.vocabulary import vocabulary
from opinara.settings import FeatureSettings

TEXT, TOKENS, KEPT, GRAMS = "combined_text", "tokens", "filtered_tokens", "ngrams"
HASHED, FEATURES = "raw_features", "features"

# Pipeline name -> (works on n-grams, weighting).
PIPELINES = {
    "count_vectorizer": (False, "count"),
    "tfidf": (False, "tfidf"),
    "ngram_cv": (True, "count"),
    "ngram_tfidf": (True, "tfidf"),
}


class NoTerms(ValueError):
    """The documents are too few, or share too few terms, for any vocabulary."""


def _counting_model(terms: list[str]) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary`` without its one call into the JVM per term."""
    separator = "\n"
    if any(separator in term for term in terms):
        return CountVectorizerModel.from_vocabulary(terms, inputCol="in", outputCol="out")
    jvm = SparkSession.active()._jvm
    array = jvm.java.util.regex.Pattern.compile(separator).split(separator.join(terms), -1)
    return CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", array
    )


class StableCountVectorizer(CountVectorizer):
    """``CountVectorizer`` whose vocabulary order never depends on partitioning.

    Ties in the built-in fit fall as the shuffle delivers them; here they go to term order.
    """

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        known = vocabulary(
            dataset, self.getInputCol(), self.getVocabSize(), self.getMinDF()
        )
        # At most vocabSize terms, which the model holds on the driver anyway.
        terms = [row.term for row in known.select("idx", "term").orderBy("idx").collect()]
        if not terms:
            raise NoTerms(f"No term is in at least {self.getMinDF():g} documents")
        return (
            _counting_model(terms)
            .setInputCol(self.getInputCol())
            .setOutputCol(self.getOutputCol())
            .setMinTF(self.getMinTF())
            .setBinary(self.getBinary())
        )


def check_name(feature_type: str) -> tuple[bool, str]:
    if feature_type not in PIPELINES:
        raise ValueError(f"Unknown feature type: {feature_type}. Choose from: {', '.join(PIPELINES)}")
    return PIPELINES[feature_type]


def text_stages() -> list[Transformer]:
    return [
        Tokenizer(inputCol=TEXT, outputCol=TOKENS),
        StopWordsRemover(inputCol=TOKENS, outputCol=KEPT),
    ]


def weighting_stages(feature_type: str, settings: FeatureSettings = FeatureSettings()) -> list:
    """Stages from the filtered tokens on; the text stages come before them."""
    grams, weighting = check_name(feature_type)
    stages = [NGram(n=settings.ngram, inputCol=KEPT, outputCol=GRAMS)] if grams else []
    source = GRAMS if grams else KEPT
    if weighting == "count":
        return stages + [
            StableCountVectorizer(
                inputCol=source, outputCol=FEATURES,
                vocabSize=settings.vocab_size, minDF=settings.min_df,
            )
        ]
    return stages + [
        HashingTF(inputCol=source, outputCol=HASHED, numFeatures=settings.vocab_size),
        IDF(inputCol=HASHED, outputCol=FEATURES),
    ]


def feature_stages(feature_type: str, settings: FeatureSettings = FeatureSettings()) -> list:
    """All stages of a named feature pipeline."""
    rest = weighting_stages(feature_type, settings)
    return text_stages() + rest
