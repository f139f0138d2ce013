"""Nearest neighbours with one vantage-point tree per shard.

Vectors are dealt to shards of about `shard_rows` rows by a hash of their id; each shard is one small task that sorts its vectors into
a vantage-point tree: a vantage point, the others split at the median of their distances to it, and the nearest and farthest distance
kept for either half. Leaves hold up to LEAF vectors. Queries go through every shard in blocks; within a shard a query visits first
the half it falls into, and a half only if the triangle inequality allows a vector there to be nearer than the k-th found so far. The
lower bound it gives is stretched by `factor`: at 1 nothing that could count is left out and the search is exact; above 1 more is
pruned. The k nearest of each shard are merged per query.

Distances are Euclidean, in double precision, between the original vectors, and are computed directly (no expansion of the square).

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows with a null id. Rows
of one id count once (the smallest vector). A query's candidates are the vectors of its own length, but its own id. Ties go to the
smaller id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

NEAREST, FACTOR = 10, 1.1
SHARD_ROWS, QUERY_ROWS, LEAF = 20_000, 1_000, 48


class Node(NamedTuple):
    """Rows first..last (in tree order); inner nodes: vantage row first, then the nearer half up to `middle` and the farther half,
    each with the least and largest distance to the vantage point and its node."""

    first: int
    last: int
    middle: int = 0
    near: tuple[float, float, int] = (0.0, 0.0, -1)
    far: tuple[float, float, int] = (0.0, 0.0, -1)


def distances(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(vectors - point).sum(axis=1))


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.nodes: list[Node] = []
        self.order = np.arange(len(ids))
        self._build(0, len(ids))
        self.ids, self.vectors = self.ids[self.order], self.vectors[self.order]

    def _build(self, first: int, last: int) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(first, last))
        if last - first > LEAF:
            rows = self.order[first:last]
            # the vector farthest from the first one: vantage points at the rim split better than inner ones
            vantage = int(distances(self.vectors[rows], self.vectors[rows[0]]).argmax())
            rows[[0, vantage]] = rows[[vantage, 0]]
            away = distances(self.vectors[rows[1:]], self.vectors[rows[0]])
            sort = np.argsort(away, kind="stable")
            self.order[first + 1 : last] = rows[1:][sort]
            away = away[sort]
            half = len(away) // 2
            middle = first + 1 + half
            near = (float(away[0]), float(away[half - 1]), self._build(first + 1, middle))
            far = (float(away[half]), float(away[-1]), self._build(middle, last))
            self.nodes[at] = Node(first, last, middle, near, far)
        return at

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and distances of the k nearest found, nearest first, ties to the smaller id."""
        return [self._one(i, q, k, factor) for i, q in zip(ids, queries, strict=True)]

    def _one(self, own: int, query: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        ids, away = np.zeros(0, np.int64), np.zeros(0)
        waiting = [(0.0, 0)]
        while waiting:
            bound, at = waiting.pop()
            # a bound equal to the k-th distance may still hide a tie with a smaller id
            if len(away) == k and bound * factor > away[-1]:
                continue
            node = self.nodes[at]
            inner = node.near[2] >= 0
            last = node.first + 1 if inner else node.last
            found = distances(self.vectors[node.first : last], query)
            new = self.ids[node.first : last]
            if inner:
                d = float(found[0])
                halves = [(max(low - d, d - high, bound), child) for low, high, child in (node.near, node.far)]
                # the half with the smaller bound is visited next; rounding of the bounds must not prune
                waiting += sorted(((max(0.0, b - 1e-9 * (1 + d)), c) for b, c in halves), reverse=True)
            keep = new != own
            if len(away) == k:
                keep &= found <= away[-1]
            if keep.any():
                ids, away = np.concatenate((ids, new[keep])), np.concatenate((away, found[keep]))
                best = np.lexsort((ids, away))[:k]
                ids, away = ids[best], away[best]
        return ids, away


def usable(vector: str = "embedding") -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & good & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array | pa.ChunkedArray, rows: np.ndarray, size: int) -> np.ndarray:
    part = column.take(pa.array(rows))
    part = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
    return part.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)


def nearest(
    embeddings: DataFrame, queries: Column, k: int = NEAREST, factor: float = FACTOR, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of `embeddings` that satisfy the condition `queries`, against all rows."""
    vectors = embeddings.where(F.col("vec_id").isNotNull()).where(usable())
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), queries.alias("asks"))
    vectors = vectors.groupBy("vec_id").agg(F.min("v").alias("v"), F.bool_or("asks").alias("asks")).withColumn("size", F.size("v"))
    n, n_asked = vectors.agg(F.count(F.lit(1)), F.count_if("asks")).head()
    shards = max(1, -(-n // shard_rows))
    own = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    asked = vectors.where("asks").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(max(1, n_asked // QUERY_ROWS))))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    # a shard's vectors meet each block of queries in a task of their own
    blocks = asked.select("size", "block").distinct()
    here = own.join(blocks, "size").select("size", "shard", "block", "vec_id", "v", F.lit(False).alias("asks"))
    there = asked.select("size", everywhere.alias("shard"), "block", "vec_id", "v", F.lit(True).alias("asks"))
    tasks = here.union(there)

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        asks = table.column("asks").to_numpy()
        size = table.column("size")[0].as_py()
        stored, asked_rows = np.flatnonzero(~asks), np.flatnonzero(asks)
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(stored) and len(asked_rows):
            tree = Tree(ids[stored], _matrix(table.column("v"), stored, size))
            found = tree.search(ids[asked_rows], _matrix(table.column("v"), asked_rows, size), k, factor)
            out["query_id"] = np.repeat(ids[asked_rows], [len(x) for x, _ in found])
            out["vec_id"] = np.concatenate([x for x, _ in found])
            out["score"] = np.concatenate([x for _, x in found])
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    found = tasks.groupBy("size", "shard", "block").applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
