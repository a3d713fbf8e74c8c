"""Nearest neighbours by cosine with vantage-point trees, one per shard.

Rows are dealt into shards of bounded size by a hash; each shard is a
vantage-point tree over its distinct directions, stored as one row.  Queries
come in blocks of bounded size.  A block runs through a group of shards one
after another, so its k-th best distance, which prunes by the triangle
inequality, shrinks as it goes; a group gives back k rows a query, and a
window merges the groups.  Pruning is relaxed by ``factor``: a subtree is left
out if factor * (distance to its border) exceeds the k-th best distance.
Factor 1 restores exact search; larger factors look at less.

The distance is the chord between unit vectors, a metric with the order of the
cosine.  Reported scores are cosines of the original vectors in double
precision, summed in component order; ties go to the smaller id.

Defined results: rows with a null id, and vectors that are null, empty, zero
or hold null or non-finite components take no part; vectors of different
length are collections of their own; a query's candidates are all rows with
another id, a repeated row counting as often as it occurs; equal queries are
answered once; with fewer than k candidates all are returned; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.grouped import each_group
from quarry.session import store

SHARD_ROWS = 4096
BLOCK_QUERIES = 512
GROUP_SHARDS = 32
LEAF = 64
SLACK = 1e-9  # of rounding, in cosines and chords
EXACT_ROWS = 1 << 15


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v")).filter(
        F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) for c in column.chunks])


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Vantage-point tree over the distinct vectors of a shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.vectors, which = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, which.ravel()))
        self.ids = ids[order]  # of equal vectors side by side, ascending
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(which.ravel(), minlength=len(self.vectors)))))
        self.unit = unit(self.vectors)
        self.order = np.arange(len(self.vectors))
        self.nodes: list[tuple] = []
        self._build(0, len(self.vectors), leaf)

    def _build(self, lo: int, hi: int, leaf: int) -> int:
        """Node (point, border, inside, outside), or (None, lo, hi, None)."""
        at = len(self.nodes)
        self.nodes.append((None, lo, hi, None))
        if hi - lo > leaf:
            part = self.order[lo:hi]
            middle = self.unit[part].mean(axis=0)
            point = self.unit[part[np.argmin(self.unit[part] @ middle)]]
            far = chord(self.unit[part] @ point)
            half = (hi - lo) // 2
            by = np.argpartition(far, half)
            border = far[by[half]]
            self.order[lo:hi] = part[by]
            inside = self._build(lo, lo + half, leaf)
            self.nodes[at] = (point, border, inside, self._build(lo + half, hi, leaf))
        return at


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of a and b, each sum in component order."""
    def dot(x, y):
        return np.add.accumulate(x * y, axis=1)[:, -1]
    squares = dot(a, a) * dot(b, b)
    if not ((squares > 1e-280) & (squares < 1e280)).all():  # lengths that would vanish or overflow
        a, b = unit(a), unit(b)
        squares = dot(a, a) * dot(b, b)
    return np.clip(dot(a, b) / np.sqrt(squares), -1.0, 1.0)


class Search:
    """The k best rows so far for each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, factor: float):
        self.ids, self.vectors, self.unit, self.k, self.factor = ids, vectors, unit(vectors), k, factor
        self.found = [(np.empty(0), np.empty(0, np.int64))] * len(ids)  # scores, ids
        self.worst = np.full(len(ids), -np.inf)  # k-th best cosine

    def run(self, tree: Tree) -> None:
        self.visit(tree, 0, np.arange(len(self.ids)))

    def visit(self, tree: Tree, at: int, q: np.ndarray) -> None:
        if not len(q):
            return
        point, border, inside, outside = tree.nodes[at]
        if point is None:
            self.leaf(tree, tree.order[border:inside], q)
            return
        gap = chord(self.unit[q] @ point) - border
        near = gap <= 0
        self.visit(tree, inside, q[near])
        self.visit(tree, outside, q[~near])
        reach = chord(np.maximum(self.worst[q], -1.0)) + SLACK
        reach[np.isinf(self.worst[q])] = np.inf
        again = self.factor * np.abs(gap) <= reach
        self.visit(tree, outside, q[near & again])
        self.visit(tree, inside, q[~near & again])

    def leaf(self, tree: Tree, members: np.ndarray, q: np.ndarray) -> None:
        close = self.unit[q] @ tree.unit[members].T >= self.worst[q][:, None] - SLACK
        rows, columns = np.nonzero(close)
        for s in range(0, len(rows), EXACT_ROWS):
            qi, vi = q[rows[s:s + EXACT_ROWS]], members[columns[s:s + EXACT_ROWS]]
            scores = exact(self.vectors[qi], tree.vectors[vi])
            ends = np.flatnonzero(np.append(np.diff(qi) != 0, True)) + 1
            for lo, hi in zip(np.concatenate(([0], ends[:-1])), ends):
                self.merge(tree, qi[lo], vi[lo:hi], scores[lo:hi])

    def merge(self, tree: Tree, q: int, members: np.ndarray, scores: np.ndarray) -> None:
        lists = [self.least(tree.ids[tree.starts[m]:tree.starts[m + 1]], self.ids[q]) for m in members]
        ids = np.concatenate([self.found[q][1], *lists])
        all_scores = np.concatenate([self.found[q][0], np.repeat(scores, [len(x) for x in lists])])
        other = ids != self.ids[q]
        ids, all_scores = ids[other], all_scores[other]
        best = np.lexsort((ids, -all_scores))[:self.k]
        self.found[q] = (all_scores[best], ids[best])
        if len(best) == self.k:
            self.worst[q] = all_scores[best[-1]]

    def least(self, ids: np.ndarray, own: int) -> np.ndarray:
        """Of the ascending ids of equal vectors those that can be among the
        k best: the k least without the query's own id, which may repeat."""
        if len(ids) <= self.k:
            return ids
        lo = np.searchsorted(ids, own)
        if lo >= self.k:
            return ids[:self.k]
        hi = np.searchsorted(ids, own, "right")
        return np.concatenate([ids[:lo], ids[hi:hi + self.k - lo]])

    def rows(self, dim: int, block: int) -> pa.RecordBatch:
        """Results; ``place`` tells apart queries of one id."""
        n = [len(x) for x, _ in self.found]
        total = sum(n)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(total, dim), pa.int32()), pa.array(np.full(total, block), pa.int64()),
            pa.array(np.repeat(self.ids, n), pa.int64()), pa.array(np.repeat(np.arange(len(n)), n), pa.int64()),
            pa.array(np.concatenate([x for _, x in self.found]), pa.int64()),
            pa.array(np.concatenate([x for x, _ in self.found]), pa.float64())], ["dim", "block", "query_id", "place", "vec_id", "score"])


def build_index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Stored index: (dim, shard, tree, shards); every usable row is in one tree."""
    rows = _rows(df, id_col, vector_col)
    shards = max(1, math.ceil(rows.count() / shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)))

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        dim = table["dim"][0].as_py()
        tree = Tree(table["id"].to_numpy(), _matrix(table["v"], dim))
        yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([table["shard"][0].as_py()], pa.int64()),
                                          pa.array([pickle.dumps(tree, 5)], pa.binary())], ["dim", "shard", "tree"])
    return store(each_group(dealt, ["dim", "shard"], "dim int, shard bigint, tree binary", work), "vp-index")


def search(index: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, id_col: str = "vec_id",
           vector_col: str = "embedding", block_queries: int = BLOCK_QUERIES, group_shards: int = GROUP_SHARDS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each query."""
    asked = store(_rows(queries, id_col, vector_col).distinct(), "vp-queries")
    blocks = max(1, math.ceil(asked.count() / block_queries))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))

    def pack(table: pa.Table) -> Iterator[pa.RecordBatch]:
        dim = table["dim"][0].as_py()
        data = (table["id"].to_numpy(), _matrix(table["v"], dim))
        yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([table["block"][0].as_py()], pa.int64()),
                                          pa.array([pickle.dumps(data, 5)], pa.binary())], ["dim", "block", "asked"])
    packed = store(each_group(dealt, ["dim", "block"], "dim int, block bigint, asked binary", pack), "vp-blocks")
    numbers = index.select("dim", "shard").groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    paired = packed.join(numbers, "dim").withColumn("shard", F.explode("shards")).drop("shards").join(index, ["dim", "shard"])
    paired = paired.withColumn("group", F.floor(F.col("shard") / group_shards))
    ordered = paired.repartition("dim", "block", "group").sortWithinPartitions("dim", "block", "group", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple(batch.column(c)[i].as_py() for c in ("dim", "block", "group"))
                if key != now:
                    if state:
                        yield state.rows(*now[:2])
                    now, state = key, Search(*pickle.loads(batch.column("asked")[i].as_py()), k, factor)
                state.run(pickle.loads(batch.column("tree")[i].as_py()))
        if state:
            yield state.rows(*now[:2])

    found = ordered.mapInArrow(run, "dim int, block bigint, query_id bigint, place bigint, vec_id bigint, score double")
    best = Window.partitionBy("dim", "block", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
