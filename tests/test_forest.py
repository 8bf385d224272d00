"""Random forests on sparse rows against Spark's own, which draws other rows and features."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window, functions as F

from opinara.plans import forest
from opinara.plans.forest import SparseRandomForestClassifier
from opinara.plans.models import classifier, load_model, save_model
from opinara.session import fresh_path


@pytest.fixture(scope="module")
def vectors(spark):
    dice = random.Random(5)
    rows = []
    for i in range(400):
        values = {f: float(dice.randint(1, 4)) for f in range(40) if dice.random() < 0.3}
        values[40] = dice.gauss(0, 1)
        truth = (values.get(3, 0) > 1) + (values.get(7, 0) > 1) + (values[40] > 0) >= 2
        vector = Vectors.sparse(50, values)
        rows.append((i, float(truth != (dice.random() < 0.1)), vector if i % 3 else Vectors.dense(vector.toArray())))
    return spark.createDataFrame(rows, ["id", "label", "features"]).cache()


def accuracy(model, rows):
    return model.transform(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]


def test_a_tree_of_all_rows_and_features_is_that_of_spark(vectors):
    """Without chance in it, each tree is Spark's decision tree."""
    settings = {"maxDepth": 4, "bootstrap": False, "featureSubsetStrategy": "all"}
    ours, own = SparseRandomForestClassifier(numTrees=2, **settings).fit(vectors), RandomForestClassifier(numTrees=1, **settings).fit(vectors)
    assert [t.numNodes for t in ours.trees] == 2 * [own.trees[0].numNodes]
    probability = lambda model: np.array([r.probability.toArray() for r in model.transform(vectors).orderBy("id").collect()])
    assert probability(ours) == pytest.approx(probability(own), abs=1e-12)


def test_forests_are_as_good_as_those_of_spark(vectors):
    settings = {"numTrees": 30, "maxDepth": 6, "seed": 3}
    ours, own = SparseRandomForestClassifier(**settings).fit(vectors), RandomForestClassifier(**settings).fit(vectors)
    assert accuracy(ours, vectors) == pytest.approx(accuracy(own, vectors), abs=0.05) and accuracy(ours, vectors) > 0.8
    assert ours.getNumTrees == 30 and ours.numFeatures == 50 and ours.numClasses == 2
    assert np.mean([t.numNodes for t in ours.trees]) == pytest.approx(np.mean([t.numNodes for t in own.trees]), rel=0.2)
    assert set(np.argsort(-ours.featureImportances.toArray())[:3]) == {3, 7, 40}


def test_the_same_seed_gives_the_same_forest_and_it_can_be_saved(spark, vectors):
    estimator = classifier("random_forest", numTrees=3, maxDepth=3)
    assert isinstance(estimator, SparseRandomForestClassifier)
    model = Pipeline(stages=[estimator]).fit(vectors)
    again = load_model(save_model(model, fresh_path(spark, "model")))
    assert again.stages[0].toDebugString.split("\n")[1:] == model.stages[0].toDebugString.split("\n")[1:]
    other = Pipeline(stages=[estimator]).fit(vectors)
    assert other.stages[0].toDebugString == model.stages[0].toDebugString


def test_columns_read_in_parts_and_other_settings(vectors, monkeypatch):
    settings = {"numTrees": 3, "maxDepth": 4, "seed": 1}
    whole = SparseRandomForestClassifier(**settings).fit(vectors)
    weighted = vectors.withColumn("w", F.lit(2.0))
    assert SparseRandomForestClassifier(numTrees=2, weightCol="w").fit(weighted).getNumTrees == 2
    assert SparseRandomForestClassifier(numTrees=2, subsamplingRate=0.5).fit(vectors).getNumTrees == 2
    alike = vectors.withColumn("features", F.first("features").over(Window.partitionBy(F.lit(1)).orderBy("id")))
    assert SparseRandomForestClassifier(**settings).fit(alike).trees[0].numNodes == 1
    monkeypatch.setattr(forest, "READ_AT_ONCE", 5)
    parts = SparseRandomForestClassifier(**settings).fit(vectors)
    assert [t.toDebugString.split("\n")[1:] for t in parts.trees] == [t.toDebugString.split("\n")[1:] for t in whole.trees]
