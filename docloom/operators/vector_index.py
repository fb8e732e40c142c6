"""Approximate dense search of a collection: inverted lists of k-means centroids, with vectors as 8-bit numbers.

Lists are a table partitioned by centroid, so a query reads the partitions of its nearest centroids alone; the best
candidates are scored again on their stored vectors. How many lists a query probes is measured when the index is built.
Later changes of the collection append to the lists; an entry that is out of date is harmless, since the stored
vector decides, until the next build. Collections of fewer rows than ``LEAST_ROWS`` are searched exactly.

An entry also holds how far its 8-bit vector lies from the vector, which bounds its score from both sides. ``exact`` reads all lists'
entries and scores every row whose bounds don't rule it out, so it finds what a scan of the vectors finds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators.search import dense_topk

if TYPE_CHECKING:
    from docloom.operators.store import Collection

#: Rows below which search is exact, and the share of components between the bounds of the 8-bit numbers.
LEAST_ROWS, QUANTILE = 10_000, 0.99
#: Bounds of what training takes and the driver holds: sampled rows, centroids, queries that the probes are measured on.
SAMPLE_ROWS, MOST_LISTS, MEASURED = 100_000, 4096, 100
#: Rows that an exact search reads by their keys; more are joined. What scores rounded to six places may differ by.
BY_KEY, ROUNDING = 2000, 1e-6
LISTS = "id {kind}, codes binary, error double, batch string, list int"


def _units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors as rows of length one; the column has no nulls, and all its vectors have one length."""
    found = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


class VectorIndex:
    def __init__(self, collection: Collection, settings: dict):
        self.collection, self.settings, self.column = collection, settings, settings["column"]

    @classmethod
    def of(cls, collection: Collection) -> VectorIndex | None:
        """The index of a collection that has one."""
        settings = collection.files.read("vectors.json")
        return cls(collection, settings) if settings else None

    @classmethod
    def build(cls, collection: Collection, column: str = "dense", lists: int | None = None, least_rows: int = LEAST_ROWS, quantile: float = QUANTILE, recall: float = 0.98, seed: int = 7) -> VectorIndex | None:
        """Trains centroids and bounds on a sample, writes every row's list entry, and measures the probes that ``recall`` needs.

        Vectors that are null, zero, of another length or without finite components aren't indexed. None, and no index, below ``least_rows``.
        """
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        collection.recover()
        rows = _usable(collection.read(collection.key, column), collection.key, column)
        told = rows.agg(F.count("*").alias("n"), F.mode(F.size("v")).alias("size")).first()
        if told.n < max(least_rows, 1):
            collection.files.delete("vectors.json")
            return None
        rows = rows.where(F.size("v") == told.size)
        share = lambda most: F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, most / told.n) * (1 << 30)) + 1
        spark, held = collection.spark, f"staged/sample-{uuid.uuid4().hex}"
        rows.where(share(SAMPLE_ROWS)).select("v").write.parquet(f"{collection.path}/{held}")  # training passes over it again and again
        sample = spark.read.schema("v array<double>").parquet(f"{collection.path}/{held}")
        k = lists or min(MOST_LISTS, max(1, round(told.n**0.5)))
        model = KMeans(k=k, maxIter=10, seed=seed, distanceMeasure="cosine", featuresCol="f").fit(sample.select(array_to_vector("v").alias("f"))) if k > 1 else None
        found = np.array(model.clusterCenters() if model else [np.ones(told.size)])
        found = found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        parts = sample.select(F.explode(F.transform("v", lambda x: x / length)).alias("x"))
        low, high = parts.agg(F.percentile_approx("x", F.array(F.lit((1 - quantile) / 2), F.lit((1 + quantile) / 2)), 10_000)).first()[0]
        name = uuid.uuid4().hex
        settings = {"column": column, "size": told.size, "low": low, "high": max(high, low + 1e-9), "centroids": name, "lists": len(found)}
        collection.files.delete(held)
        spark.createDataFrame(list(enumerate(found.tolist())), "list int, vector array<double>").coalesce(1).write.parquet(f"{collection.path}/centroids/{name}")
        index = cls(collection, settings)
        settings["probes"] = index._measured(rows, rows.where(share(MEASURED)).limit(4 * MEASURED), recall)
        collection.rebuild("lists", lambda folder: index.write(collection.read(collection.key, column), folder), vectors=settings)
        return index

    def centroids(self) -> np.ndarray:
        rows = self.collection.spark.read.parquet(f"{self.collection.path}/centroids/{self.settings['centroids']}").orderBy("list").collect()  # MOST_LISTS at most
        return np.array([r.vector for r in rows])

    def _measured(self, rows: DataFrame, queries: DataFrame, recall: float, k: int = 10) -> int:
        """Probes of which the sampled rows' lists hold that share of their true nearest rows."""
        asked = queries.collect()
        units = np.array([r.v for r in asked], np.float64)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        centroids = self.centroids()
        ranks = np.argsort(np.argsort(-(units @ centroids.T), axis=1), axis=1)  # of each list, for each query
        ids = [r.id for r in asked]

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                vectors, own = _units(batch.column(1)), batch.column(0).to_pylist()
                scores, lists = units @ vectors.T, np.argmax(vectors @ centroids.T, axis=1)
                best = np.argsort(-scores, axis=1)[:, : k + 1]
                out = [(q, float(scores[q, j]), int(ranks[q, lists[j]])) for q in range(len(ids)) for j in best[q] if own[j] != ids[q]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 3, [pa.int32(), pa.float64(), pa.int32()], strict=True)], ["q", "score", "rank"])

        found = rows.select("id", "v").mapInArrow(nearest, "q int, score double, rank int")
        top = found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("n") <= k)
        needed = sorted(r["rank"] for r in top.select("rank").collect())  # k for each of the sampled queries
        return needed[min(len(needed) - 1, int(recall * len(needed)))] + 1 if needed else 1

    def write(self, rows: DataFrame, folder: str) -> None:
        """List entries of rows (the key and the vector)."""
        kind = dict(rows.dtypes)[self.collection.key]
        usable = _usable(rows, self.collection.key, self.column).where(F.size("v") == self.settings["size"])
        entries = usable.mapInArrow(_entries(self.centroids(), self.settings["low"], self.settings["high"]), f"id {kind}, codes binary, error double, list int")
        entries.hint("rebalance", "list").sortWithinPartitions("list").write.partitionBy("list").parquet(folder)

    def candidates(self, query: list[float], most: int, probes: int | None = None) -> DataFrame:
        """``id, score``: the best rows of the probed lists by their 8-bit vectors."""
        unit = np.asarray(query, np.float64)
        unit = unit / (np.linalg.norm(unit) or 1.0)
        order = np.argsort(-(self.centroids() @ unit))[: probes or self.settings["probes"]]
        collection = self.collection
        kind = dict(collection.read(collection.key).dtypes)[collection.key]
        lists = collection.spark.read.schema(LISTS.format(kind=kind)).parquet(f"{collection.path}/lists").where(F.col("list").isin([int(x) for x in order]))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int8).reshape(len(batch), -1)
                    scores = codes.astype(np.float32) @ unit.astype(np.float32)
                    top = np.argpartition(-scores, min(4 * most, len(scores)) - 1)[: 4 * most]  # repeated entries of a row are folded below
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(top)), pa.array(scores[top].astype(np.float64))], ["id", "score"])

        found = lists.select("id", "codes").mapInArrow(best, f"id {kind}, score double")
        return found.groupBy("id").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "id").limit(most)

    def topk(self, query: list[float], k: int = 5, probes: int | None = None, oversample: int = 8) -> DataFrame:
        """``id, score``, with exact scores: the stored vectors of ``k * oversample`` candidates are read by their keys."""
        ids = [r.id for r in self.candidates(query, k * oversample, probes).collect()]
        return dense_topk(self.collection.of_keys(ids), query, k, self.collection.key, self.column)

    def _bounds(self, query: list[float]) -> DataFrame:
        """``id, low, high``: between which a row's score lies. Of several entries of a row, one is up to date."""
        unit = np.asarray(query, np.float64)
        unit = unit / (np.linalg.norm(unit) or 1.0)
        collection, low, high = self.collection, self.settings["low"], self.settings["high"]
        kind = dict(collection.read(collection.key).dtypes)[collection.key]
        lists = collection.spark.read.schema(LISTS.format(kind=kind)).parquet(f"{collection.path}/lists")
        entries = lists.select("id", "codes", F.coalesce("error", F.lit(2.0)).alias("error"))  # entries of older indexes have no error

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int8).reshape(len(batch), -1)
                    scores, errors = _decoded(codes, low, high) @ unit, batch.column(2).to_numpy() + 1e-9
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores - errors), pa.array(scores + errors)], ["id", "low", "high"])

        return entries.mapInArrow(score, f"id {kind}, low double, high double").groupBy("id").agg(F.min("low").alias("low"), F.max("high").alias("high"))

    def exact(self, query: list[float], k: int = 5) -> DataFrame:
        """``id, score``: the rows that a scan of all vectors finds. Entries of rows that are deleted may set the first bar too high; then it is lowered to
        the score of the last row found, without k rows to nothing."""
        collection = self.collection
        stored = collection.read(collection.key, self.column)
        if len(query) != self.settings["size"]:
            return dense_topk(stored, query, k, collection.key, self.column)
        bounds = self._bounds(query)
        best = bounds.orderBy(F.desc("low")).limit(k).collect()
        bar = best[-1].low if len(best) == k else -np.inf
        while bar > -np.inf:
            left = bounds.where(F.col("high") >= float(bar - 2 * ROUNDING)).select("id")
            few = left.limit(BY_KEY + 1).collect()
            rows = collection.of_keys([r.id for r in few]) if len(few) <= BY_KEY else stored.join(left.withColumnRenamed("id", collection.key), collection.key, "left_semi")
            found = dense_topk(rows, query, k, collection.key, self.column)
            scores = [r.score for r in found.collect()]
            if len(scores) == k and scores[-1] >= bar - ROUNDING:
                return found
            bar = scores[-1] if len(scores) == k else -np.inf
        return dense_topk(stored, query, k, collection.key, self.column)


def _usable(rows: DataFrame, key: str, column: str) -> DataFrame:
    """``id, v``: vectors with a direction."""
    found = rows.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("v")).where("v IS NOT NULL")
    return found.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0))


def _decoded(codes: np.ndarray, low: float, high: float) -> np.ndarray:
    return (codes.astype(np.float64) + 128) / 255 * (high - low) + low


def _entries(centroids: np.ndarray, low: float, high: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                units = _units(batch.column(1))
                codes = np.clip(np.rint((units - low) / (high - low) * 255 - 128), -128, 127).astype(np.int8)
                lists = np.argmax(units @ centroids.T, axis=1).astype(np.int32)
                errors = np.linalg.norm(units - _decoded(codes, low, high), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors), pa.array(lists)], ["id", "codes", "error", "list"])

    return run


def vector_topk(collection: Collection, query: list[float], k: int = 5, column: str = "dense", exact: bool = False) -> DataFrame:
    """``id, score`` by cosine: from the collection's index (with ``exact``, the rows that a scan finds), or exactly where it has none."""
    index = VectorIndex.of(collection)
    if index and index.column == column:
        return index.exact(query, k) if exact else index.topk(query, k)
    return dense_topk(collection.read(collection.key, column), query, k, collection.key, column)
