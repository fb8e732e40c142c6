"""Operator 9: approximate nearest neighbours by stable projections and a kd-tree.

Vectors are brought to one Euclidean problem (a further component lifts all candidates to one norm,
so the largest inner product is the smallest distance) and projected to ``DIMS`` dimensions by a
Gaussian (2-stable) matrix. Each shard indexes its projected points by a kd-tree. A query takes the
tree's leaves in the order of their projected distance, and of their points verifies those on the original
vectors for which the chi-square test fails: a point as near as the current k-th would, with probability
``SURE``, have a smaller projected distance. Its search ends at the first leaf for which the test holds.

A first round takes the nearest leaf of each shard; the k-th of what all shards found is shared with
the second, which therefore stops as if all vectors were in one tree, and begins behind that leaf.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch
from docloom.llm.vector_grid import Grid, dots, fewest_ids, halves

DIMS, LEAF, SURE, SEED, QUERIES_AT_ONCE = 24, 48, 0.88, 7, 256


def chi2_cdf(x: float, dims: int) -> float:
    """Chi-square distribution with an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, dims // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi2_quantile(share: float, dims: int) -> float:
    low, high = 0.0, 20.0 * dims
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, dims) < share else (low, middle)
    return high


def search_shard(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, norm2: float, least: np.ndarray | None = None, first_only: bool = False, verified: list | None = None, begun: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, id, score) of the ``k`` nearest found in one shard, the query's own id left out.

    ``least``: scores that each query has ``k`` of already, ``begun``: how many leaves were read for them.
    ``verified`` takes how many points were verified.
    """
    ids, vectors = fewest_ids(ids, vectors, k + 1)  # in the order of the ids, so row numbers break ties
    lift = np.sqrt(np.maximum(norm2 - (vectors**2).sum(1), 0))
    plane = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, DIMS))
    points, asked = np.c_[vectors, lift] @ plane, queries @ plane[:-1]
    leaves = [x for x in halves(points, LEAF)[-1] if len(x)]
    low, high = np.array([points[x].min(0) for x in leaves]), np.array([points[x].max(0) for x in leaves])
    most = max(map(len, leaves))
    rows = np.array([np.r_[x, np.full(most - len(x), -1)] for x in leaves])
    least = np.full(len(queries), -np.inf) if least is None else least
    limit, lengths = chi2_quantile(SURE, DIMS), (points**2).sum(1)  # the test holds from `limit` times the k-th squared distance on
    out = []
    for begin in range(0, len(queries), QUERIES_AT_ONCE):
        part = slice(begin, begin + QUERIES_AT_ONCE)
        q, own, at, floor = queries[part], query_ids[part], asked[part], least[part].copy()
        near = sum(np.maximum(np.maximum(low[None, :, i] - at[:, None, i], at[:, None, i] - high[None, :, i]), 0) ** 2 for i in range(DIMS))
        order = np.argsort(near, 1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        distance = lengths - 2 * at @ points.T + (at**2).sum(1)[:, None]
        best, best_at = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, dtype=np.int64)
        live, base = np.arange(len(q)), norm2 + (q**2).sum(1)
        for step in range(1) if first_only else range(begun, len(leaves)):
            kth = np.maximum(base - 2 * floor, 1e-12)  # squared distance; infinite while there are fewer than k
            live = live[near[live, step] < limit * kth[live]]
            if not len(live):
                break
            got = rows[order[live, step]]
            r, c = np.nonzero((got >= 0) & (ids[got] != own[live][:, None]) & (distance[live[:, None], got] < limit * kth[live][:, None]))
            if not len(r):
                continue
            if verified is not None:
                verified.append(len(r))
            score = np.full(got.shape, -np.inf)
            score[r, c] = np.einsum("ij,ij->i", q[live[r]], vectors[got[r, c]])
            changed = np.unique(r)
            score, found, to = np.c_[best[live[changed]], score[changed]], np.c_[best_at[live[changed]], got[changed]], live[changed]
            pick = np.lexsort((found, -score))[:, :k]
            best[to], best_at[to] = np.take_along_axis(score, pick, 1), np.take_along_axis(found, pick, 1)
            floor[to] = np.maximum(floor[to], best[to, -1])
        r, c = np.nonzero(np.isfinite(best) & (best >= least[part][:, None] - 1e-9 * np.abs(least[part][:, None])))
        out.append((r + begin, ids[best_at[r, c]], dots(q[r], vectors[best_at[r, c]])))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, by inner product in doubles.

    Every row with another id than the query's and a vector of the same length is a candidate. Null, zero and
    non-finite vectors take no part; a null id takes no part; rows repeated exactly count once; ties go to the
    smaller id; with fewer candidates than ``k`` all are returned; an empty table gives no rows. Further columns
    are not looked at.
    """
    with scratch.scope() as leave:
        grid = Grid(df, id_col, vec_col, is_query, drop_zero=True)
        norm2 = grid.norm2

        def search(first_only: bool):
            def run(ids: np.ndarray, vectors: np.ndarray, asked: pd.DataFrame, queries: np.ndarray) -> tuple:
                return search_shard(ids, vectors, asked["id"].to_numpy(), queries, k, norm2, asked["least"].to_numpy(), first_only, begun=0 if first_only else 1)

            return run

        first = grid.search(search(True), grid.queries().withColumn("least", F.lit(float("-inf"))))
        first = leave(scratch.keep(grid.best(first, k).select("key", "id", "score")))
        found = first.union(grid.search(search(False), leave(scratch.keep(grid.shared(first, k))))).distinct()
        leave(grid.rows)
        return grid.top(found, k).select("query_id", F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")
