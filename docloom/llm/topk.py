"""Operator 10: exact top-k inner products by ball-tree branch and bound in each shard.

Every shard has a ball tree. A first round visits only the ball of the largest inner-product bound in
each shard; the k-th best score over all shards is then shared with every shard, and the second round
descends the trees level by level, dropping each ball whose bound ``q.c + |q| r`` is under the shared
or own k-th score, and visits the remaining leaves with the largest bound first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch
from docloom.llm.vector_grid import Grid, far_pair, fewest_ids, halves

LEAF, QUERIES_AT_ONCE = 16, 256


def search_shard(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int, first_only: bool, verified: list | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, id, score) of the up to ``k`` best scores of at least ``least`` in one shard. ``verified`` takes how many vectors were scored."""
    ids, vectors = fewest_ids(ids, vectors, k + 1)
    levels = [[x for x in level if len(x)] for level in halves(vectors, LEAF, far_pair)]
    balls = []
    for level in levels:
        centre = np.array([vectors[x].mean(0) for x in level])
        balls.append((centre, np.array([np.sqrt(((vectors[x] - c) ** 2).sum(1).max()) for x, c in zip(level, centre, strict=True)])))
    # halves() splits every node of a level in two, so node i has the children 2i and 2i+1; none is empty until LEAF is reached.
    whole = all(len(x) == 2**d for d, x in enumerate(levels))
    most = max(map(len, levels[-1]))
    rows = np.array([np.r_[x, np.full(most - len(x), -1)] for x in levels[-1]])
    out = []
    for begin in range(0, len(queries), QUERIES_AT_ONCE):
        part = slice(begin, begin + QUERIES_AT_ONCE)
        q, own, floor = queries[part], query_ids[part], least[part].copy()
        length = np.sqrt((q**2).sum(1))
        bound = np.full((len(q), 1), np.inf)
        for depth, (centre, radius) in enumerate(balls):
            if not whole and depth < len(balls) - 1:
                continue
            if whole and depth:
                bound = np.repeat(bound, 2, 1)
            else:
                bound = np.full((len(q), len(radius)), np.inf)
            r, c = np.nonzero(bound >= floor[:, None])
            fresh = (q[r] * centre[c]).sum(1) + length[r] * radius[c]
            bound[r, c] = np.minimum(bound[r, c], fresh + 1e-9 * (1 + np.abs(fresh)))
        order = np.argsort(-bound, 1, kind="stable")
        bound = np.take_along_axis(bound, order, 1)
        best, best_id = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, dtype=np.int64)
        live = np.flatnonzero(bound[:, 0] >= floor)
        for step in range(1 if first_only else rows.shape[0]):
            if not len(live):
                break
            got = rows[order[live, step]]
            if verified is not None:
                verified.append(int((got >= 0).sum()))
            score = np.matmul(vectors[got], q[live][:, :, None])[:, :, 0]  # whole numbers: exact in doubles, in any order
            found = ids[got]
            score[(got < 0) | (found == own[live][:, None])] = -np.inf
            score, found = np.c_[best[live], score], np.c_[best_id[live], found]
            pick = np.lexsort((found, -score))[:, :k]
            best[live], best_id[live] = np.take_along_axis(score, pick, 1), np.take_along_axis(found, pick, 1)
            floor[live] = np.maximum(floor[live], best[live, -1])
            if step + 1 < rows.shape[0]:
                live = live[bound[live, step + 1] >= floor[live]]
        r, c = np.nonzero(np.isfinite(best) & (best >= least[part][:, None]))
        out.append((r + begin, best_id[r, c], best[r, c]))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products of the vectors
    ``floor(scale * x)``, exactly, ties to the smaller id.

    Every row with another id than the query's and a vector of the same length is a candidate. Vectors null or
    with null or non-finite components take no part, nor do null ids or vectors without components; zero vectors do.
    Rows repeated exactly count once; with fewer candidates than ``k`` all are returned; an empty table gives no
    rows; further columns are not looked at. Scores are exact while they stay under 2**53; beyond the range of a
    long, components and scores are the nearest long.
    """
    whole = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.when(F.abs(x) < float("inf"), F.floor(F.greatest(F.least(x * scale, F.lit(2.0**62)), F.lit(-(2.0**62)))).cast("double")))
    with scratch.scope() as leave:
        grid = Grid(df.select(F.col(id_col).alias("id"), is_query.alias("query"), whole.alias("vec")), "id", "vec", F.col("query"), drop_zero=False)

        def search(first_only: bool):
            def run(ids: np.ndarray, vectors: np.ndarray, asked: pd.DataFrame, queries: np.ndarray) -> tuple:
                return search_shard(ids, vectors, asked["id"].to_numpy(), queries, asked["least"].to_numpy(), k, first_only)

            return run

        first = grid.search(search(True), grid.queries().withColumn("least", F.lit(float("-inf"))))
        found = grid.search(search(False), leave(scratch.keep(grid.shared(first, k))))
        leave(grid.rows)
        score = F.greatest(F.least("score", F.lit(2.0**63 - 1024)), F.lit(-(2.0**63))).cast("long")
        return grid.top(found, k).select("query_id", F.col("rank").cast("int"), F.col("id").alias("vec_id"), score.alias("score"))
