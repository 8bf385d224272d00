"""Classifiers by name, full pipelines, and what to do with a fitted one."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame, SparkSession

from opinara.functions.predictions import positive_probability
from opinara.operators.weights import weights_of
from opinara.plans.boosting import SparseGBTClassifier
from opinara.plans.features import FEATURES, feature_stages
from opinara.plans.forest import SparseRandomForestClassifier
from opinara.settings import SEED, FeatureSettings


class TwoClassNaiveBayes(NaiveBayes):
    """Multinomial naive Bayes over the classes 0 and 1, also where all rows are of one of them.

    Spark's fit then knows that class only and predicts 0 whichever it is. Here the other one has counts of zero.
    """

    def _fit(self, dataset: DataFrame) -> NaiveBayesModel:
        fitted = super()._fit(dataset)
        if fitted.numClasses != 1:
            return fitted
        label, rows = dataset.groupBy(self.getLabelCol()).count().first()
        counts = np.zeros(2)
        counts[int(label)] = rows
        pi = np.log(counts + self.getSmoothing()) - np.log(rows + 2 * self.getSmoothing())
        theta = np.full((2, fitted.numFeatures), -np.log(fitted.numFeatures))
        theta[int(label)] = fitted.theta.toArray()[0]
        whole = NaiveBayesModel._create_from_java_class(
            "org.apache.spark.ml.classification.NaiveBayesModel", fitted.uid,
            DenseVector(pi), DenseMatrix(*theta.shape, theta.ravel(order="F")), DenseMatrix(0, 0, []),
        )
        return self._copyValues(whole)


# Hyperparameters the comparison is defined by.
MODELS = {
    "logistic_regression": (LogisticRegression, {"maxIter": 100}),
    "naive_bayes": (TwoClassNaiveBayes, {"smoothing": 1.0}),
    "random_forest": (SparseRandomForestClassifier, {"numTrees": 100, "maxDepth": 10, "seed": SEED}),
    "gbt": (SparseGBTClassifier, {"maxIter": 50, "maxDepth": 5, "seed": SEED}),
}


def classifier(model: str, **overrides) -> Estimator:
    if model not in MODELS:
        raise ValueError(f"Unknown model: {model}. Choose from: {', '.join(MODELS)}")
    kind, defaults = MODELS[model]
    return kind(featuresCol=FEATURES, labelCol="label", **(defaults | overrides))


def full_pipeline(
    feature_type: str, model: str, settings: FeatureSettings = FeatureSettings(), **overrides
) -> Pipeline:
    """Feature stages and classifier as one estimator over ``combined_text`` and ``label``."""
    return Pipeline(stages=feature_stages(feature_type, settings) + [classifier(model, **overrides)])


def score(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """Append ``prediction`` and ``prob``; with ``keep``, only those and the named columns."""
    scored = model.transform(df).withColumn("prob", positive_probability())
    return scored.select(*keep, "prediction", "prob") if keep else scored


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def weights_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Vocabulary, coefficients and intercept of a fitted linear model as a table."""
    vocabularies = [s for s in model.stages if isinstance(s, CountVectorizerModel)]
    linear = [s for s in model.stages if isinstance(s, LogisticRegressionModel)]
    if not vocabularies or not linear:
        raise ValueError("Only a linear model on counted terms has one weight per term")
    return weights_of(
        spark, vocabularies[0].vocabulary, linear[0].coefficients.toArray().tolist(), linear[0].intercept
    )
