"""Random forests on sparse rows: the forest of ``RandomForestClassifier``, without a number per row and feature.

As in :mod:`opinara.plans.boosting` a row is the bins of its terms. All trees grow together, a level in one pass: each
node draws its features, and only the columns drawn are read, so that a level's work grows with the entries of the
rows. Sums travel by node; the driver gets the best split of each node, of which there are at most 2^depth a tree.

Draws of rows (Poisson) and features come from the seed, the tree and the node, not from Spark's generator: a forest
is one of those that Spark's could be, not the same trees. Splits, stopping and pruning are Spark's, and the result is its
``RandomForestClassificationModel``. Other settings (weights, other subsets, impurities, more classes) go to Spark's own fit.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.operators.prep import keep, release
from opinara.plans.boosting import Block, Layout, blocks_of, sparse_rows, thresholds
from opinara.session import map_batches, write_once

READ_AT_ONCE = 1 << 20  # entries of columns looked at in one go
SPLITS = "place int, gain double, feature int, bin int, left array<double>, total array<double>"
CHOSEN = pa.schema([
    ("place", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()),
    ("left", pa.list_(pa.float64())), ("total", pa.list_(pa.float64())),
])


class Forest:
    """Trees as rows of arrays: the children of node ``i`` are ``2 i + 1`` and ``2 i + 2``; no feature: a leaf."""

    def __init__(self, trees: int, depth: int):
        shape = (trees, (2 << depth) - 1)
        self.feature, self.bin = np.full(shape, -1, np.int32), np.zeros(shape, np.int32)
        self.gain, self.stats = np.zeros(shape), np.zeros((*shape, 2))


def gini(stats: np.ndarray) -> np.ndarray:
    total = np.maximum(stats.sum(axis=-1), 1e-300)
    return 1.0 - ((stats / total[..., None]) ** 2).sum(axis=-1)


class Columns:
    """A block's entries by row, to look a feature up, and by feature, to read columns."""

    def __init__(self, block: Block, layout: Layout):
        self.block, self.layout = block, layout
        self.slots = len(layout.owner)
        self.keys = block.row * self.slots + block.slots  # rising: features rise within a row
        feature = layout.owner[block.slots]
        self.order = np.argsort(feature, kind="stable")
        self.starts = np.searchsorted(feature[self.order], np.arange(len(layout.zero) + 1))
        self.crc = zlib.crc32(block.raw[2], zlib.crc32(block.raw[0]))

    def drawn(self, seed: int, tree: int) -> np.ndarray:
        """How often the tree takes each row, the same in every pass."""
        return np.random.default_rng([seed, tree, self.crc]).poisson(1.0, len(self.block.labels))

    def nodes(self, feature: np.ndarray, bin_: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The node of each of the rows, as far down as the tree is split."""
        layout, node, live = self.layout, np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(live := live[feature[node[live]] >= 0]):
            at_node = node[live]
            asked = feature[at_node]
            first = rows[live] * self.slots + layout.offsets[asked]
            at = np.searchsorted(self.keys, first)
            key = self.keys[np.minimum(at, len(self.keys) - 1)] if len(self.keys) else np.full(len(at), -1)
            own = np.where((key >= first) & (key < first + layout.offsets[asked + 1] - layout.offsets[asked]), key - first, layout.zero[asked])
            node[live] = 2 * at_node + 1 + (own > bin_[at_node])
        return node


def subset(seed: int, tree: int, node: int, features: int, size: int) -> np.ndarray:
    """The features that a node may be split by."""
    return np.random.default_rng([seed, tree, node, 1]).choice(features, size, replace=False)


def merged(keys: list[np.ndarray], stats: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their columns."""
    found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.array([np.bincount(inverse, s, len(found)) for s in np.concatenate(stats, axis=1)])


def best_splits(blocks: DataFrame, layout, forest: Forest, places: np.ndarray, seed: int, size: int, bootstrap: bool, least: int, parts: int) -> DataFrame:
    """The best split of each place, a tree and a node of it, among the features drawn for it."""
    feature, bin_, at_once = forest.feature, forest.bin, READ_AT_ONCE
    trees = {int(tree): np.flatnonzero(places[:, 0] == tree) for tree in np.unique(places[:, 0])}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = layout.value
        slots, count = len(known.owner), len(places)
        drawn = {}
        totals, keys, stats, held = np.zeros((2, count)), [np.zeros(0, np.int64)], [np.zeros((2, 0))], 0
        for batch in batches:
            for at in range(batch.num_rows):
                columns = Columns(Block(batch, at, known), known)
                block = columns.block
                for tree, own in trees.items():
                    if tree not in drawn:
                        drawn[tree] = np.concatenate([subset(seed, tree, int(places[p, 1]), len(known.zero), size) for p in own]).astype(np.int32)
                    times = columns.drawn(seed, tree) if bootstrap else np.ones(len(block.labels), np.int64)
                    rows = np.flatnonzero(times)
                    place = np.full(feature.shape[1], -1)
                    place[places[own, 1]] = own
                    place_of = np.full(len(times), -1)
                    place_of[rows] = place[columns.nodes(feature[tree], bin_[tree], rows)]
                    rows = np.flatnonzero(place_of >= 0)
                    weight = np.array([times * (block.labels == c) for c in (0.0, 1.0)])
                    totals += [np.bincount(place_of[rows], w[rows], count) for w in weight]
                    asked, by = drawn[tree], np.repeat(own, size)
                    lengths = columns.starts[asked + 1] - columns.starts[asked]
                    some = np.flatnonzero(lengths)
                    turns = np.cumsum(lengths[some]) // at_once
                    for cut in np.split(some, np.flatnonzero(np.diff(turns)) + 1):
                        n = lengths[cut]
                        entry = columns.order[np.repeat(columns.starts[asked[cut]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                        at_place, row = np.repeat(by[cut], n), block.row[entry]
                        inside = place_of[row] == at_place
                        row = row[inside]
                        found = merged([at_place[inside] * slots + block.slots[entry[inside]]], [weight[:, row]])
                        keys.append(found[0])
                        stats.append(found[1])
                        held += len(found[0])
                    if held > 4 * at_once + 2 * len(keys[0]):
                        keys, stats = ([x] for x in merged(keys, stats))
                        held = len(keys[0])
        keys, stats = merged(keys, stats)
        part = keys // slots % parts
        for number in range(parts):
            own = part == number
            columns = [keys[own].tobytes(), np.ascontiguousarray(stats[:, own]).tobytes(), np.ascontiguousarray(totals[:, number::parts]).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)], ["part", "keys", "sums", "totals"])

    def choose(table: pa.Table) -> pa.Table:
        known, number = layout.value, table.column("part")[0].as_py()
        slots, features = len(known.owner), len(known.zero)
        own = np.arange(number, len(places), parts)
        whole = sum(np.frombuffer(b.as_py()) for b in table.column("totals")).reshape(2, -1).T
        keys, sums = merged(*([np.frombuffer(b.as_py(), k).reshape(shape) for b in table.column(c)] for c, k, shape in (("keys", np.int64, -1), ("sums", np.float64, (2, -1)))))
        sums = sums.T
        # Zeros have no entries: what a node's total holds beyond the bins of a feature.
        pair = keys // slots * features + known.owner[keys % slots]
        heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
        place, feature = np.divmod(pair[heads], features)
        rest = whole[place // parts] - (np.add.reduceat(sums, heads, axis=0) if len(heads) else np.zeros((0, 2)))
        keys = np.concatenate([keys, place * slots + known.offsets[feature] + known.zero[feature]])
        turn = np.argsort(keys, kind="stable")
        keys, sums = keys[turn], np.concatenate([sums, rest])[turn]
        sizes = np.diff(np.append(heads, len(pair))) + 1
        starts = np.cumsum(sizes) - sizes
        left = sums.copy()
        for step in range(1, int(sizes.max(initial=0))):
            at = starts[sizes > step] + step
            left[at] += left[at - 1]
        place = keys // slots
        total = whole[place // parts]
        right = total - left
        share = left.sum(axis=1) / np.maximum(total.sum(axis=1), 1)
        gain = gini(total) - share * gini(left) - (1 - share) * gini(right)
        gain[(left.sum(axis=1) < least) | (right.sum(axis=1) < least)] = -1.0
        best = np.lexsort((np.arange(len(gain)), -gain, place))
        best = best[np.concatenate([[True], place[best][1:] != place[best][:-1]])] if len(best) else best
        slot = keys[best] % slots
        told = known.owner[slot]
        none = np.setdiff1d(own, place[best])  # no feature drawn has two values there
        zeros = np.zeros(len(none))
        columns = [
            np.concatenate([place[best], none]), np.concatenate([gain[best], zeros - 1]), np.concatenate([told, zeros]),
            np.concatenate([slot - known.offsets[told], zeros]), [*left[best], *np.zeros((len(none), 2))],
            [*total[best], *whole[none // parts]],
        ]
        return pa.table([pa.array(c if isinstance(c, list) else c.astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(columns, CHOSEN)], CHOSEN)

    gathered = map_batches(blocks, gather, "part int, keys binary, sums binary, totals binary")
    return gathered.groupBy("part").applyInArrow(choose, SPLITS)


def grow(blocks: DataFrame, layout, trees: int, depth: int, seed: int, size: int, bootstrap: bool, least: int, least_gain: float, parts: int) -> Forest:
    """All trees, level by level."""
    forest, places = Forest(trees, depth), [(tree, 0) for tree in range(trees)]
    for level in range(depth):
        following = []
        # A row per node of the level.
        for row in best_splits(blocks, layout, forest, np.array(places), seed, size, bootstrap, least, parts).collect():
            tree, node = places[row.place]
            total, left = np.array(row.total), np.array(row.left)
            forest.stats[tree, node] = total
            if row.gain <= 0 or row.gain < least_gain:
                continue
            forest.feature[tree, node], forest.bin[tree, node], forest.gain[tree, node] = row.feature, row.bin, row.gain
            for child, stats in ((2 * node + 1, left), (2 * node + 2, total - left)):
                forest.stats[tree, child] = stats
                if gini(stats) >= np.finfo(float).eps:
                    following.append((tree, child))
        places = sorted(following)
        if not places:
            break
    return forest


def _java_tree(spark: SparkSession, forest: Forest, tree: int, layout: Layout, uid: str):
    context, jvm = spark.sparkContext, spark._jvm
    # Looked up once: each step of a Java name is a call.
    ml, part_of = jvm.org.apache.spark.ml.tree, jvm.java.util.Arrays.copyOfRange
    leaf, inner, split, counted = ml.LeafNode, ml.InternalNode, ml.ContinuousSplit, jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator
    stats, impure, feature = forest.stats[tree], gini(forest.stats[tree]), forest.feature[tree]
    predicted = stats.argmax(axis=1)
    flat = _py2java(context, Vectors.dense(stats.ravel().tolist())).toArray()

    def same(node: int) -> bool:
        """Whether all leaves below predict one class; Spark merges those."""
        return feature[node] < 0 or pruned[2 * node + 1] and pruned[2 * node + 2] and predicted[2 * node + 1] == predicted[2 * node + 2]

    pruned = np.zeros(len(feature), bool)
    for node in reversed(range(len(feature))):
        pruned[node] = same(node)

    def made(node: int):
        own = counted(part_of(flat, 2 * node, 2 * node + 2), int(stats[node].sum()))
        value, spread = float(predicted[node]), float(impure[node])
        if pruned[node]:
            return leaf(value, spread, own)
        asked = int(feature[node])
        cut = layout.thresholds[layout.offsets[asked] - asked + forest.bin[tree, node]]
        children = made(2 * node + 1), made(2 * node + 2)
        return inner(value, spread, float(forest.gain[tree, node]), *children, split(asked, float(cut)), own)

    return jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel(uid, made(0), len(layout.zero), 2)


class SparseRandomForestClassifier(RandomForestClassifier):
    """``RandomForestClassifier`` whose work grows with the entries of sparse rows, not with rows times features."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        if not self._covered(dataset):
            return super()._fit(dataset)
        spark = dataset.sparkSession
        rows = write_once(sparse_rows(dataset, self.getFeaturesCol(), self.getLabelCol()), "tree-rows")
        odd = F.count_if(~F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False)) | F.col("values").isNull())
        count, size, wrong, classes = rows.agg(F.count(F.lit(1)), F.max("size"), odd, F.max("label")).first()
        if not count or wrong or classes != 1.0:
            return super()._fit(dataset)
        cores = spark.sparkContext.defaultParallelism
        layout = Layout.of(size, thresholds(rows, count, min(self.getMaxBins(), count)))
        shared = spark.sparkContext.broadcast(layout)
        blocks = keep(blocks_of(rows.repartition(cores), shared))
        drawn, seed = size if self.getFeatureSubsetStrategy() == "all" else math.ceil(math.sqrt(size)), self.getSeed() % (1 << 63)
        settings = (self.getNumTrees(), self.getMaxDepth(), seed, drawn, self.getBootstrap(), self.getMinInstancesPerNode(), self.getMinInfoGain(), 2 * cores)
        try:
            forest = grow(blocks, shared, *settings)
        finally:
            release(blocks)
            shared.unpersist()
        return self._model(spark, forest, layout)

    def _covered(self, dataset: DataFrame) -> bool:
        named = self.isDefined(self.getParam("weightCol"))
        whole = self.getSubsamplingRate() == 1.0 and self.getNumTrees() > 1
        drawn = self.getFeatureSubsetStrategy() in ("auto", "sqrt", "all") and self.getImpurity() == "gini"
        known = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        plain = set(known) <= {"numeric"} and self.getMaxDepth() > 0 and self.getMinWeightFractionPerNode() == 0.0
        return not named and whole and drawn and plain

    def _model(self, spark: SparkSession, forest: Forest, layout: Layout) -> RandomForestClassificationModel:
        kind = spark._jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel
        made = spark.sparkContext._gateway.new_array(kind, len(forest.feature))
        for number in range(len(made)):
            made[number] = _java_tree(spark, forest, number, layout, f"{self.uid}_{number}")
        java = spark._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(self.uid, made, len(layout.zero), 2)
        model = self._copyValues(RandomForestClassificationModel(java))
        model._transfer_params_to_java()  # the model's own texts name them
        return model
