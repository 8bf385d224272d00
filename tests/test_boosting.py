"""Boosted trees on sparse rows against Spark's own."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from opinara.plans import boosting
from opinara.plans.boosting import SparseGBTClassifier
from opinara.plans.models import classifier, load_model, save_model
from opinara.session import fresh_path


@pytest.fixture(scope="module")
def vectors(spark):
    dice = random.Random(5)
    rows = []
    for i in range(300):
        values = {f: float(dice.randint(1, 4)) for f in range(40) if dice.random() < 0.2}
        values |= {40: dice.gauss(0, 1), 41: -dice.random()}
        truth = values.get(3, 0) + values.get(7, 0) + values[40] > 1.5
        vector = Vectors.sparse(50, values)
        rows.append((i, float(truth != (dice.random() < 0.1)), vector if i % 3 else Vectors.dense(vector.toArray())))
    return spark.createDataFrame(rows, ["id", "label", "features"]).cache()


def margins(model, rows):
    return np.array([r.rawPrediction[1] for r in model.transform(rows).orderBy("id").collect()])


@pytest.mark.parametrize("settings", [{"maxIter": 6, "maxDepth": 5}, {"maxIter": 3, "maxDepth": 2, "minInstancesPerNode": 9, "maxBins": 7}])
def test_trees_are_those_of_spark(vectors, settings):
    ours, own = SparseGBTClassifier(**settings).fit(vectors), GBTClassifier(**settings).fit(vectors)
    assert margins(ours, vectors) == pytest.approx(margins(own, vectors), abs=1e-9)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in own.trees]
    assert ours.treeWeights == own.treeWeights and ours.numFeatures == own.numFeatures
    # Later trees have splits of equal gain, between which rounding decides; the sums of the first are whole.
    assert ours.trees[0].featureImportances.toArray() == pytest.approx(own.trees[0].featureImportances.toArray(), abs=1e-9)


def test_wide_levels_take_several_passes(vectors, monkeypatch):
    once = margins(SparseGBTClassifier(maxIter=2, maxDepth=4).fit(vectors), vectors)
    monkeypatch.setattr(boosting, "PASS_BYTES", 1)
    assert margins(SparseGBTClassifier(maxIter=2, maxDepth=4).fit(vectors), vectors) == pytest.approx(once, abs=1e-12)


def test_a_row_is_held_by_its_entries(spark):
    """A row of 3 entries among 65,536 features takes bytes for 3."""
    rows = spark.createDataFrame([(float(i % 2), Vectors.sparse(65_536, {i % 9: 1.0, 100: 2.0, 65_000: float(i % 3 + 1)})) for i in range(90)], ["label", "features"])
    sparse = boosting.sparse_rows(rows, "features", "label")
    layout = boosting.Layout.of(65_536, boosting.thresholds(sparse, 90, 32))
    held = boosting.blocks_of(sparse.coalesce(1), spark.sparkContext.broadcast(layout))
    assert held.agg(F.sum(sum(F.length(c) for c in ("labels", "ends", "slots", "margins")))).first()[0] <= 90 * (8 + 8 + 12 + 8)


def test_the_grid_uses_them_and_saves_them(spark, vectors):
    estimator = classifier("gbt", maxIter=2)
    assert isinstance(estimator, SparseGBTClassifier)
    from pyspark.ml import Pipeline

    model = Pipeline(stages=[estimator]).fit(vectors)
    again = load_model(save_model(model, fresh_path(spark, "model")))
    assert margins(again, vectors) == pytest.approx(margins(model, vectors), abs=0)


def test_other_settings_go_to_spark(vectors):
    weighted = vectors.withColumn("w", F.lit(2.0))
    assert SparseGBTClassifier(maxIter=2, weightCol="w").fit(weighted).getNumTrees == 2
    assert SparseGBTClassifier(maxIter=2, subsamplingRate=0.5).fit(vectors).getNumTrees == 2
