"""Boosted trees on sparse rows: the trees of ``GBTClassifier``, without a number per row and feature.

Spark's own fit holds every row as one bin per feature, zeros included, and walks all of them at each level
of each tree. With 65,536 terms that is 256 kB for a review of some hundred words. Here a row is the bins of its
terms: each level of a tree is one pass that sums count, residual and its square per node and bin, combined per
task; what zeros add is a node's total less the bins seen. The sums travel by ranges of features, so that no
task and not the driver holds those of all tasks; the driver gets the best split of each range.

Splits, losses and stopping are those of Spark's trees, and the result is its ``GBTClassificationModel``.
Thresholds come from all values, where Spark samples tables of over 10,000 rows. Settings that the sums do not
cover (weights, subsampling, subsets of features, early stopping, nominal features) are left to Spark's own fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.operators.prep import keep, release
from opinara.session import map_batches, materialize, write_once

VALUE_GROUPS = 256  # features are dealt into so many groups to find their thresholds
PASS_BYTES = 1 << 28  # sums a task holds at once; wider levels take several passes
CHECKPOINT_TREES = 10
BLOCKS = "labels binary, ends binary, slots binary, margins binary"
SPLITS = "node int, gain double, feature int, bin int, left array<double>, total array<double>"
CHOSEN = pa.schema([
    ("node", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()),
    ("left", pa.list_(pa.float64())), ("total", pa.list_(pa.float64())),
])


@dataclass
class Layout:
    """Bins of all features side by side: feature ``f`` has the slots from ``offsets[f]`` on."""

    offsets: np.ndarray
    thresholds: np.ndarray  # one less than slots for each feature
    zero: np.ndarray  # the bin of 0
    owner: np.ndarray  # feature of each slot

    @staticmethod
    def of(features: int, found: dict[int, list[float]]) -> Layout:
        sizes = np.ones(features, np.int64)
        zero = np.zeros(features, np.int32)
        for feature, cuts in found.items():
            sizes[feature] += len(cuts)
            zero[feature] = np.searchsorted(cuts, 0.0)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = [cut for feature in sorted(found) for cut in found[feature]]
        return Layout(offsets, np.array(flat, np.float64), zero, np.repeat(np.arange(features, dtype=np.int32), sizes))

    def bins(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Thresholds of the feature below the value, by bisection."""
        first = self.offsets[feature] - feature
        low, high = first.copy(), self.offsets[feature + 1] - feature - 1
        while (open_ := low < high).any():
            middle = (low + high) // 2
            above = open_.copy()
            above[open_] = self.thresholds[middle[open_]] < value[open_]
            low, high = np.where(above, middle + 1, low), np.where(open_ & ~above, middle, high)
        return low - first


class Tree:
    """A tree as arrays: the children of node ``i`` are ``2 i + 1`` and ``2 i + 2``; no feature: a leaf."""

    def __init__(self, depth: int):
        size = (2 << depth) - 1
        self.feature, self.bin = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        self.gain, self.stats = np.zeros(size), np.zeros((size, 3))

    def prediction(self) -> np.ndarray:
        return self.stats[:, 1] / np.maximum(self.stats[:, 0], 1)


def impurity(stats: np.ndarray) -> np.ndarray:
    """Variance from count, sum and sum of squares along the last axis."""
    n = np.maximum(stats[..., 0], 1)
    return (stats[..., 2] - stats[..., 1] * stats[..., 1] / n) / n


def sparse_rows(rows: DataFrame, features: str, label: str) -> DataFrame:
    """``label, size, indices, values`` of vectors of either kind."""
    vector = F.unwrap_udt(F.col(features))
    rows = rows.select(F.col(label).cast("double").alias("label"), vector.alias("v"))
    places = F.when(F.col("v.type") == 0, F.col("v.indices")).when(
        F.size("v.values") > 0, F.sequence(F.lit(0), F.size("v.values") - 1)
    )
    return rows.select(
        "label", F.coalesce("v.size", F.size("v.values")).alias("size"),
        F.coalesce(places, F.array().cast("array<int>")).alias("indices"), F.col("v.values").alias("values"),
    )


def thresholds(rows: DataFrame, count: int, bins: int) -> dict[int, list[float]]:
    """At most ``bins - 1`` thresholds per feature, between values; features of one value have none."""
    entries = rows.select(F.inline(F.arrays_zip("indices", "values"))).filter("values <> 0")
    counts = entries.groupBy(F.col("indices").alias("feature"), F.col("values").alias("value")).agg(F.count(F.lit(1)).alias("n"))

    def cuts(table: pa.Table) -> pa.Table:
        feature, value, n = (table.column(c).to_numpy() for c in ("feature", "value", "n"))
        turn = np.lexsort((value, feature))
        feature, value, n = feature[turn], value[turn], n[turn]
        starts = np.flatnonzero(np.concatenate([[True], feature[1:] != feature[:-1]]))
        found = [_cuts(value[a:b], n[a:b], count, bins) for a, b in zip(starts, [*starts[1:], len(feature)])]
        return pa.table({"feature": pa.array(feature[starts], pa.int32()), "cuts": pa.array(found, pa.list_(pa.float64()))})

    dealt = counts.groupBy((F.col("feature") % VALUE_GROUPS).alias("part"))
    found = dealt.applyInArrow(cuts, "feature int, cuts array<double>")
    # At most one row per feature of ``bins`` numbers, which the trees are made of.
    return {row.feature: row.cuts for row in found.filter(F.size("cuts") > 0).collect()}


def _cuts(values: np.ndarray, counts: np.ndarray, total: int, bins: int) -> list[float]:
    """Midpoints of neighbouring values; where there are too many, those nearest to equal shares."""
    zeros = total - int(counts.sum())
    if zeros > 0:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    middles = (values[1:] + values[:-1]) / 2.0
    if len(middles) < bins:
        return middles.tolist()
    stride = total / bins
    found, target, current = [], stride, int(counts[0])
    for i, count in enumerate(counts[1:].tolist()):
        before, current = current, current + count
        if abs(before - target) < abs(current - target):
            found.append(float(middles[i]))
            target += stride
    return found


class Block:
    """Some rows: their labels and margins, and the slots of their entries."""

    def __init__(self, record: pa.RecordBatch, at: int, layout: Layout):
        self.raw = [record.column(i)[at].as_py() for i in range(4)]
        kinds = (np.float64, np.int64, np.int32, np.float64)
        self.labels, ends, self.slots, self.margins = (np.frombuffer(r, k) for r, k in zip(self.raw, kinds))
        self.row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        self.layout = layout

    def residuals(self, first: bool) -> np.ndarray:
        signs = 2 * self.labels - 1
        return signs if first else 4.0 * signs / (1.0 + np.exp(2.0 * signs * self.margins))

    def nodes(self, tree: Tree) -> np.ndarray:
        """The node of each row, as far down as the tree is split."""
        node = np.zeros(len(self.labels), np.int64)
        feature = self.layout.owner[self.slots]
        for _ in range(len(tree.feature).bit_length() - 1):
            asked = tree.feature[node]
            inner = asked >= 0
            if not inner.any():
                break
            own = self.layout.zero[asked]
            hit = np.flatnonzero(feature == asked[self.row])
            own[self.row[hit]] = self.slots[hit] - self.layout.offsets[feature[hit]]
            node = np.where(inner, 2 * node + 1 + (own > tree.bin[node]), node)
        return node


def blocks_of(rows: DataFrame, layout) -> DataFrame:
    """The rows in blocks, of which a task reads whole arrays; entries that fall into zero's bin are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = layout.value
        for batch in batches:
            if not batch.num_rows:
                continue
            indices, values = batch.column(1), batch.column(2)
            bounds = indices.offsets.to_numpy().astype(np.int64)
            feature = indices.values.to_numpy()[bounds[0] : bounds[-1]].astype(np.int64)
            edges = values.offsets.to_numpy()
            bin_ = known.bins(feature, values.values.to_numpy()[edges[0] : edges[-1]])
            told = bin_ != known.zero[feature]
            ends = np.concatenate([[0], np.cumsum(told)])[bounds[1:] - bounds[0]]
            slots = (known.offsets[feature] + bin_)[told].astype(np.int32)
            labels = batch.column(0).to_numpy()
            columns = [labels, ends.astype(np.int64), slots, np.zeros(len(labels))]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["labels", "ends", "slots", "margins"])

    return map_batches(rows.select("label", "indices", "values"), run, BLOCKS)


def with_margins(blocks: DataFrame, layout, tree: Tree, weight: float) -> DataFrame:
    """The blocks with ``weight`` times the tree's prediction added to each margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prediction = tree.prediction()
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch, at, layout.value)
                margins = block.margins + weight * prediction[block.nodes(tree)]
                columns = [pa.array([c], pa.binary()) for c in (*block.raw[:3], margins.tobytes())]
                yield pa.RecordBatch.from_arrays(columns, ["labels", "ends", "slots", "margins"])

    return map_batches(blocks, run, BLOCKS)


def summed(keys: np.ndarray, stats: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below ``size`` in order, and the sums of their columns of ``stats``."""
    if len(keys) * 4 < size:
        found, inverse = np.unique(keys, return_inverse=True)
        return found, np.array([np.bincount(inverse, s, len(found)) for s in stats])
    found = np.flatnonzero(np.bincount(keys, minlength=size))
    return found, np.array([np.bincount(keys, s, size)[found] for s in stats])


def best_splits(blocks: DataFrame, layout, tree: Tree, nodes: list[int], first: bool, least: int, parts: int) -> DataFrame:
    """For each range of features and node its best split, with the sums of the left child and of the node.

    A key is a node's place in the list times the number of slots, plus the slot.
    """
    places = np.full(len(tree.feature), -1)
    places[nodes] = np.arange(len(nodes))
    slots = len(layout.value.owner)
    # Ranges of whole features with about the same number of slots.
    edges = np.unique(np.searchsorted(layout.value.offsets, np.linspace(0, slots, parts + 1)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = layout.value, len(nodes) * slots
        totals, keys, stats = np.zeros((3, len(nodes))), np.zeros(0, np.int64), np.zeros((3, 0))
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch, at, known)
                place = places[block.nodes(tree)]
                residual = block.residuals(first)
                listed = np.flatnonzero(place >= 0)
                powers = residual ** np.arange(3)[:, None]
                totals += [np.bincount(place[listed], w[listed], len(nodes)) for w in powers]
                entries = np.flatnonzero(place[block.row] >= 0)
                row = block.row[entries]
                own = summed(place[row] * slots + block.slots[entries], powers[:, row], size)
                keys, stats = np.concatenate([keys, own[0]]), np.concatenate([stats, own[1]], axis=1)
                if len(keys) > size:
                    keys, stats = summed(keys, stats, size)
        keys, stats = summed(keys, stats, size)
        part = np.searchsorted(known.offsets[edges], keys % slots, "right") - 1
        for number in range(len(edges) - 1):
            own = part == number
            columns = [keys[own].tobytes(), np.ascontiguousarray(stats[:, own]).tobytes(), totals.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)], ["part", "keys", "sums", "totals"])

    def choose(table: pa.Table) -> pa.Table:
        known = layout.value
        keys = [np.frombuffer(b.as_py(), np.int64) for b in table.column("keys")]
        stats = [np.frombuffer(b.as_py()).reshape(3, -1) for b in table.column("sums")]
        totals = sum(np.frombuffer(b.as_py()) for b in table.column("totals")).reshape(3, len(nodes)).T
        found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.array([np.bincount(inverse, s, len(found)) for s in np.concatenate(stats, axis=1)]).T.reshape(-1, 3)
        if not len(found):
            return pa.table({name: [] for name in CHOSEN.names}, CHOSEN)
        # Zeros have no entries: what a node's total holds beyond the bins of a feature.
        own = found // slots * len(known.zero) + known.owner[found % slots]
        pairs = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        node, feature = np.divmod(own[pairs], len(known.zero))
        rest = totals[node] - np.add.reduceat(sums, pairs, axis=0)
        found = np.concatenate([found, node * slots + known.offsets[feature] + known.zero[feature]])
        turn = np.argsort(found)
        found, sums = found[turn], np.concatenate([sums, rest])[turn]
        # From each pair's first bin on; its last one has nothing to its right.
        sizes = np.diff(np.append(pairs, len(own))) + 1
        starts = np.cumsum(sizes) - sizes
        left = sums.copy()
        for step in range(1, int(sizes.max())):  # within each pair alone, so that equal sums stay equal
            at = starts[sizes > step] + step
            left[at] += left[at - 1]
        node = np.repeat(node, sizes)
        whole = totals[node]
        right = whole - left
        share = left[:, 0] / whole[:, 0]
        gain = impurity(whole) - share * impurity(left) - (1 - share) * impurity(right)
        gain[(left[:, 0] < least) | (right[:, 0] < least)] = -1.0
        gain[starts + sizes - 1] = -1.0
        heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        best = np.array([a + int(gain[a:b].argmax()) for a, b in zip(heads, [*heads[1:], len(node)])])
        feature = known.owner[found[best] % slots]
        bin_ = found[best] % slots - known.offsets[feature]
        columns = [np.array(nodes)[node[best]], gain[best], feature, bin_, list(left[best]), list(whole[best])]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, CHOSEN)], CHOSEN)

    gathered = map_batches(blocks, gather, "part int, keys binary, sums binary, totals binary")
    return gathered.groupBy("part").applyInArrow(choose, SPLITS)


def grow(blocks: DataFrame, layout, first: bool, depth: int, least: int, least_gain: float, parts: int) -> Tree:
    """One regression tree on the residuals, level by level."""
    tree, nodes = Tree(depth), [0]
    at_once = max(PASS_BYTES // (24 * len(layout.value.owner)), 1)
    for level in range(depth):
        following = []
        for start in range(0, len(nodes), at_once):
            some = nodes[start : start + at_once]
            # A row per range of features and node.
            found = best_splits(blocks, layout, tree, some, first, least, parts).collect()
            for node in some:
                best = max((row for row in found if row.node == node), key=lambda row: (row.gain, -row.feature), default=None)
                if best is None:  # rows of zeros only
                    continue
                total, left = np.array(best.total), np.array(best.left)
                tree.stats[node] = total
                if best.gain <= 0 or best.gain < least_gain:
                    continue
                tree.feature[node], tree.bin[node], tree.gain[node] = best.feature, best.bin, best.gain
                for child, stats in ((2 * node + 1, left), (2 * node + 2, total - left)):
                    tree.stats[child] = stats
                    if abs(impurity(stats)) >= np.finfo(float).eps:
                        following.append(child)
        nodes = following
        if not nodes:
            break
    return tree


def _java_tree(spark: SparkSession, tree: Tree, layout: Layout, uid: str):
    context, jvm = spark.sparkContext, spark._jvm
    ml, prediction, impure = jvm.org.apache.spark.ml.tree, tree.prediction(), impurity(tree.stats)

    def made(node: int):
        stats = _py2java(context, Vectors.dense(tree.stats[node].tolist())).toArray()
        own = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(tree.stats[node][0]))
        value, spread, feature = float(prediction[node]), float(impure[node]), int(tree.feature[node])
        if feature < 0:
            return ml.LeafNode(value, spread, own)
        cut = layout.thresholds[layout.offsets[feature] - feature + tree.bin[node]]
        children = made(2 * node + 1), made(2 * node + 2)
        return ml.InternalNode(value, spread, float(tree.gain[node]), *children, ml.ContinuousSplit(feature, float(cut)), own)

    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(uid, made(0), len(layout.zero))


class SparseGBTClassifier(GBTClassifier):
    """``GBTClassifier`` whose work grows with the entries of sparse rows, not with rows times features."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        if not self._covered(dataset):
            return super()._fit(dataset)
        spark = dataset.sparkSession
        rows = write_once(sparse_rows(dataset, self.getFeaturesCol(), self.getLabelCol()), "tree-rows")
        odd = F.count_if(~F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False)) | F.col("values").isNull())
        count, size, wrong = rows.agg(F.count(F.lit(1)), F.max("size"), odd).first()
        if not count or wrong:
            return super()._fit(dataset)  # which says what is wrong
        cores = spark.sparkContext.defaultParallelism
        layout = Layout.of(size, thresholds(rows, count, min(self.getMaxBins(), count)))
        shared = spark.sparkContext.broadcast(layout)
        blocks = keep(blocks_of(rows.repartition(cores), shared))
        grown = (self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain(), 2 * cores)
        trees: list[Tree] = []
        before = blocks
        try:
            for number in range(self.getMaxIter()):
                trees.append(grow(blocks, shared, number == 0, *grown))
                if before is not blocks:
                    release(before)
                before = blocks
                # Computed and cached by the first pass of the next tree.
                added = with_margins(blocks, shared, trees[-1], self._weight(number))
                blocks = keep(materialize(added) if number % CHECKPOINT_TREES == CHECKPOINT_TREES - 1 else added)
        finally:
            release(before)
            release(blocks)
            shared.unpersist()
        return self._model(spark, trees, layout)

    def _covered(self, dataset: DataFrame) -> bool:
        named = [p for p in ("weightCol", "validationIndicatorCol") if self.isDefined(self.getParam(p))]
        whole = self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() == "all"
        known = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        plain = set(known) <= {"numeric"} and self.getMaxDepth() > 0 and self.getMinWeightFractionPerNode() == 0.0
        return not named and whole and plain

    def _weight(self, number: int) -> float:
        return 1.0 if number == 0 else self.getStepSize()

    def _model(self, spark: SparkSession, trees: list[Tree], layout: Layout) -> GBTClassificationModel:
        gateway, jvm = spark.sparkContext._gateway, spark._jvm
        kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        made, weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
        for number, tree in enumerate(trees):
            made[number] = _java_tree(spark, tree, layout, f"{self.uid}_{number}")
            weights[number] = self._weight(number)
        java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, made, weights, len(layout.zero), 2)
        return self._copyValues(GBTClassificationModel(java))
