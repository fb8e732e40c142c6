"""A stated query set against all vectors, in blocks: candidates fall into shards, queries into blocks,
and each task holds one shard and one block of queries (both bounded), whatever the table's size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm import scratch

SHARD_ROWS, BLOCK_ROWS, LEAST_SHARDS, LEAST_ROWS = 8192, 1024, 32, 256


class Grid:
    """``rows``: one row per usable, distinct (id, vector), with its shard and its row key.

    Vectors that are null, hold null or non-finite components (or, with ``drop_zero``, only zeros)
    take no part. Vectors of each length are searched apart. Rows repeated exactly count once.
    """

    def __init__(self, df: DataFrame, id_col: str, vec_col: str, is_query: Column, drop_zero: bool):
        vec = F.col(vec_col).cast("array<double>")
        usable = df.where(is_query.isNotNull() & vec.isNotNull()).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), is_query.alias("query"))
        usable = usable.where(F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))  # NaN is above infinity
        if drop_zero:
            usable = usable.where(F.exists("vec", lambda x: x != 0))
        usable = usable.where(F.size("vec") > 0).dropDuplicates(["id", "vec"])
        rows = scratch.keep(usable.withColumn("key", F.monotonically_increasing_id()))
        n, queries, norm = rows.agg(F.count("*"), F.count_if("query"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))).first()
        self.rows, self.norm2 = rows, norm or 0.0
        self.shards = max(1, -(-n // SHARD_ROWS), min(LEAST_SHARDS, -(-n // LEAST_ROWS)))
        self.blocks = max(1, -(-queries // BLOCK_ROWS))

    def queries(self) -> DataFrame:
        return self.rows.where("query").select("key", "id", "vec")

    def shared(self, found: DataFrame, k: int) -> DataFrame:
        """The queries with ``least``, the ``k``-th best score that each has over all shards."""
        kth = self.best(found, k).where(F.col("rank") == k).select("key", F.col("score").alias("least"))
        return self.queries().join(kth, "key", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))

    def search(self, f: Callable[[np.ndarray, np.ndarray, pd.DataFrame, np.ndarray], tuple], queries: DataFrame) -> DataFrame:
        """``f(ids, vectors, queries, query_vectors)`` -> (query's place, id, score) arrays; one row each."""
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        shard, block = F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int"), F.pmod(F.xxhash64("key"), F.lit(self.blocks)).cast("int")
        left = self.rows.select(F.col("id").alias("own_id"), F.col("vec").alias("own_vec"), shard.alias("own_s"), F.size("vec").alias("own_dim")).withColumn("own_b", spread(self.blocks))
        right = queries.withColumn("b", block).withColumn("dim", F.size("vec")).withColumn("s", spread(self.shards))

        def run(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if not len(own) or not len(asked):
                return pd.DataFrame({"key": [], "id": [], "score": []})
            at, ids, scores = f(own["own_id"].to_numpy(), np.stack(own["own_vec"].to_numpy()), asked, np.stack(asked["vec"].to_numpy()))
            return pd.DataFrame({"key": asked["key"].to_numpy()[at], "id": ids, "score": scores})

        return left.groupBy("own_s", "own_b", "own_dim").cogroup(right.groupBy("s", "b", "dim")).applyInPandas(run, "key long, id long, score double")

    def best(self, found: DataFrame, k: int) -> DataFrame:
        """The ``k`` best of each query over all shards, with their ``rank``, ties to the smaller id."""
        order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def top(self, found: DataFrame, k: int) -> DataFrame:
        """The same with the queries' ids."""
        return self.best(found, k).join(self.queries().select("key", F.col("id").alias("query_id")), "key")


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products over the last axis, added in order, so equal vectors get equal scores."""
    out = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1])
    for i in range(a.shape[-1]):
        out += a[..., i] * b[..., i]
    return out


def widest_axis(own: np.ndarray) -> np.ndarray:
    return own[:, np.argmax(own.max(0) - own.min(0))]


def far_pair(own: np.ndarray) -> np.ndarray:
    """Places along the line through two points far from each other."""
    one = own[np.argmax(((own - own.mean(0)) ** 2).sum(1))]
    other = own[np.argmax(((own - one) ** 2).sum(1))]
    return own @ (other - one)


def halves(points: np.ndarray, leaf: int, along: Callable[[np.ndarray], np.ndarray] = widest_axis) -> list[list[np.ndarray]]:
    """Levels of a balanced binary tree: each level's nodes as arrays of row numbers, split at the median of ``along``."""
    levels = [[np.arange(len(points))]]
    while max(map(len, levels[-1])) > leaf:
        below = []
        for rows in levels[-1]:
            order = rows[np.argsort(along(points[rows]), kind="stable")] if len(rows) else rows
            below += [order[: len(order) // 2], order[len(order) // 2 :]]
        levels.append(below)
    return levels


def fewest_ids(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors only the ``k`` smallest ids can be among the best: the others are left out."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    _, group = np.unique(np.ascontiguousarray(vectors).view(f"V{vectors.shape[1] * 8}").ravel(), return_inverse=True)
    by = np.argsort(group, kind="stable")
    first = np.r_[0, np.flatnonzero(np.diff(group[by])) + 1]
    place = np.arange(len(by)) - np.repeat(first, np.diff(np.r_[first, len(by)]))
    keep = np.sort(by[place < k])
    return ids[keep], vectors[keep]
