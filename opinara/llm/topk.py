"""Exact top-k search by inner product with a KD-tree per shard.

Components are turned into floor(256 * x), so scores are whole numbers and exact. Vectors are dealt to
shards by hash. A task holds one shard and one group of queries: it splits the shard at medians into
a KD-tree whose nodes keep tight bounding boxes, then walks it best first for each query, by the
largest inner product any point of a box could have. It stops at the first box below the k-th
score found so far. Each query first searches one home shard; the k-th score from there goes along to
all other shards, which only answer with what can still enter the list.

Shards and query groups have a bounded number of rows, so a task's memory is bounded. Queries are a
stated set held against all rows, in blocks; only row groups, not pairs, are shuffled.

Scores that fit doubles exactly are worked out in these, larger ones as longs, and where a sum need
not fit a long, as whole numbers of any width: rounded scores with a bound on their error pick the few rows
that are then scored exactly.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part;
neither do rows with a null id. A score beyond a long is ranked exactly and shown as null. Only vectors
of equal length are compared. Rows with the query's own id are no candidates; other ids that
occur more than once are a candidate each time. Queries that share an id are one query, the row of
the least vector. Ties go to the smaller id. Other columns play no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from opinara.llm.frames import materialize, ship

K, SCALE, EVERY = 5, 256, 50
LEAF_ROWS, SHARD_ROWS, GROUP_ROWS = 128, 16_384, 16_384
HITS = "query_id long, vec_id long, score long, beyond binary"
WHOLE = 2.0**45  # from here on doubles have no digits below 1/256
LONG = 1 << 63


def encoded(score: int) -> bytes:
    """Bytes in the order of the whole numbers they stand for."""
    size = (score.bit_length() + 8) // 8
    found = size.to_bytes(8, "big") + abs(score).to_bytes(size, "big")
    return b"\1" + found if score >= 0 else b"\0" + bytes(255 - b for b in found)


def decoded(code: bytes) -> int:
    return int.from_bytes(code[9:], "big") if code[0] else -int.from_bytes(bytes(255 - b for b in code[9:]), "big")


class Tree:
    """Median splits along the widest side; children of node i are listed in ``left`` and ``right``."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(ids))
        self.spans, self.left, self.right, lows, highs = [], [], [], [], []
        waiting = [(0, len(ids), -1, False)] if len(ids) else []
        while waiting:
            start, stop, parent, is_right = waiting.pop()
            node, rows = len(self.spans), self.order[start:stop]
            inside = points[rows]
            lows.append(inside.min(0))
            highs.append(inside.max(0))
            self.spans.append((start, stop))
            self.left.append(-1)
            self.right.append(-1)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            # Halves by rank, so equal points do not make a branch endless.
            if stop - start > leaf_rows:
                middle = (stop - start) // 2
                side = int(np.argmax(highs[-1] - lows[-1]))
                self.order[start:stop] = rows[np.argpartition(inside[:, side], middle)]
                waiting += [(start + middle, stop, node, True), (start, start + middle, node, False)]
        self.ids, self.points = ids[self.order], points[self.order]
        self.lows, self.highs = (np.array(b, np.float64) if b else np.zeros((0, points.shape[1])) for b in (lows, highs))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that any point of each node's box can score, by query and node."""
        q = queries.astype(np.float64)
        most = np.maximum(q, 0) @ self.highs.T + np.minimum(q, 0) @ self.lows.T
        # Sums past 2^53 are rounded; the slack keeps them upper bounds.
        return most + np.where(np.abs(most) > 2.0**50, 2.0**-40 * (np.abs(q) @ np.maximum(np.abs(self.highs), np.abs(self.lows)).T), 0)

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, kth: float, exact=None) -> list[tuple[int, int]]:
        """Up to k pairs of score and id, none below ``kth``, best first.

        Scores are ``points @ query``; with ``exact`` they only say which rows may enter, and it scores these.
        """
        best: list[tuple[int, int]] = []  # a heap of (score, -id)
        bound = bound.tolist()  # plain numbers compare exactly, however large
        heap = [(-bound[0], 0)] if len(self.spans) else []
        while heap:
            most, node = heapq.heappop(heap)
            if -most < kth:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bound[child] >= kth:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            start, stop = self.spans[node]
            scores = self.points[start:stop] @ query if exact is None else exact.most(start, stop, query)
            for at in np.flatnonzero(scores >= kth) if exact is None else np.argsort(-scores, kind="stable"):
                if exact is not None and float(scores[at]) < kth:
                    break
                score = int(scores[at]) if exact is None else exact.score(start + at, query)
                entry = (score, -int(self.ids[start + at]))
                if -entry[1] == own or score < kth:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if exact is not None and len(best) == k:
                    kth = max(kth, best[0][0])
            if len(best) == k:
                kth = max(kth, best[0][0])
        return [(score, -minus) for score, minus in sorted(best, reverse=True)]


class Exact:
    """Scores of any width, and doubles they cannot pass. Points and queries are in units of 1/256."""

    def __init__(self, points: np.ndarray, safe: bool):
        self.points, self.sizes, self.safe = points, np.abs(points), safe

    def most(self, start: int, stop: int, query: np.ndarray) -> np.ndarray:
        if not self.safe:
            return np.full(stop - start, np.inf)
        # Far more than the rounding of a sum of so many products.
        slack = (len(query) + 4) * 2.0**-51 * (self.sizes[start:stop] @ np.abs(query))
        return SCALE * SCALE * (self.points[start:stop] @ query + slack) + 1

    def score(self, at: int, query: np.ndarray) -> int:
        return sum(_in_256ths(a) * _in_256ths(b) for a, b in zip(self.points[at].tolist(), query.tolist()))


def _in_256ths(value: float) -> int:
    return int(value) * SCALE if abs(value) >= WHOLE else int(value * SCALE)


def _stacked(table: pa.Table, column: str) -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def search_shard(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    hits: list[list] = [[], [], [], []]
    if rows.num_rows and queries.num_rows:
        points, wanted = _stacked(rows, "vector"), _stacked(queries, "vector")
        ids, owns = rows.column("vec_id").to_numpy(), queries.column("own").to_pylist()
        # As whole numbers, so no product is rounded.
        sizes = [_in_256ths(float(np.abs(v).max())) for v in (points, wanted)]
        largest = max(sizes[0], 1) * max(sizes[1], 1) * points.shape[1]
        exact = None
        if largest < 2**52 or largest < LONG and max(sizes) < 2**53:
            # Doubles hold whole numbers exactly below 2^53 and multiply faster.
            kind = np.float64 if largest < 2**52 else np.int64
            points, wanted = ((v * SCALE).astype(kind) for v in (points, wanted))
            tree = Tree(ids, points)
            bounds = tree.bounds(wanted)
        else:
            safe = largest < 2**900 and max(sizes) < 2**900
            tree = Tree(ids, points)
            exact = Exact(tree.points, safe)
            bounds = np.full((len(wanted), len(tree.spans)), np.inf)
            if safe:
                reach = np.maximum(np.abs(tree.highs), np.abs(tree.lows))
                slack = (points.shape[1] + 4) * 2.0**-51 * (np.abs(wanted) @ reach.T)
                bounds = SCALE * SCALE * (np.maximum(wanted, 0) @ tree.highs.T + np.minimum(wanted, 0) @ tree.lows.T + slack) + 1
        floors = zip(queries.column("floor").to_pylist(), queries.column("floor_beyond").to_pylist())
        for at, (own, (floor, beyond)) in enumerate(zip(owns, floors)):
            kth = decoded(beyond) if beyond is not None else -np.inf if floor is None else floor
            for score, vec_id in tree.search(wanted[at], own, bounds[at], k, kth, exact):
                fits = -LONG <= score < LONG
                for column, value in zip(hits, (own, vec_id, score if fits else None, None if fits else encoded(score))):
                    column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(("query_id", "vec_id", "score", "beyond"), hits, kinds)})


def whole_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector, size`` with components cut down to whole 256ths, only rows that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", bad))

    def whole(x):
        x = x.cast("double")
        return F.when(F.abs(x) >= WHOLE, x).otherwise(F.floor(x * SCALE).cast("double") / SCALE)

    return rows.select("vec_id", F.transform("vector", whole).alias("vector"), F.size("vector").alias("size"))


# From the largest score to the least: above all longs, longs, below all longs.
TIER = "case when beyond is null then 1 when beyond >= X'01' then 2 else 0 end"


def top_k(
    vectors: DataFrame, key="vec_id", vector="embedding", k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for queries whose id is divisible by ``every``."""
    ship(vectors.sparkSession)
    rows = whole_vectors(vectors, key, vector)
    queries = rows.filter(F.col("vec_id") % every == 0)
    queries = queries.groupBy("vec_id", "size").agg(F.min("vector").alias("vector"))
    only = Window.partitionBy("vec_id").orderBy("vector")
    queries = queries.withColumn("at", F.row_number().over(only)).filter("at = 1").drop("at")
    shards = max(1, -(-rows.count() // shard_rows))
    groups = max(1, -(-queries.count() // GROUP_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)))
    queries = queries.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)))
    queries = materialize(queries.withColumn("home", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards))))

    copies = rows.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    first = queries.withColumns({"shard": F.col("home"), "floor": F.lit(None).cast("long"), "floor_beyond": F.lit(None).cast("binary")})
    found = materialize(_searched(copies, first, k))
    floors = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.expr(TIER).alias("tier"), "score", "beyond")).alias("least"))
    full = [F.when(F.col("n") == k, F.col(f"least.{c}")).alias(name) for c, name in (("score", "floor"), ("beyond", "floor_beyond"))]
    floors = floors.select("query_id", *full)
    rest = queries.join(floors, F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
    rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    found = found.union(_searched(copies, rest.filter("shard <> home"), k))
    best = Window.partitionBy("query_id").orderBy(F.expr(TIER).desc(), F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searched(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    parts = ("size", "shard", "group")
    left = rows.select(*parts, "vec_id", "vector").groupBy(*parts)
    right = queries.select(*parts, F.col("vec_id").alias("own"), "vector", "floor", "floor_beyond").groupBy(*parts)
    return left.cogroup(right).applyInArrow(lambda a, b: search_shard(a, b, k), HITS)
