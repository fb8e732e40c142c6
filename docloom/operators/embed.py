"""Dense vectors for texts. The embedder is a function of a list of texts, so a remote service, a model or the
offline hashing embedder can stand behind it; it runs inside Spark tasks, a batch of texts at a time."""

from __future__ import annotations

import threading
import time
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.sources.http import Retry, TooLong, Unavailable, request

__all__ = ["Retry", "TooLong", "Unavailable", "embed", "hashing_embedder", "http_embedder", "precomputed"]


def hashing_embedder(size: int) -> Callable[[list[str]], list[np.ndarray]]:
    """Signed counts of hashed words, of length 1. Deterministic; needs no model."""

    def embed(texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            codes = np.array([zlib.crc32(w.encode()) for w in text.lower().split()], dtype=np.int64)
            vector = np.bincount(codes % size, weights=np.where((codes >> 16) & 1, 1.0, -1.0), minlength=size)
            out.append((vector / (np.linalg.norm(vector) or 1.0)).astype(np.float32))
        return out

    return embed


def http_embedder(url: str, model: str, token: str | None = None, timeout_s: float = 90) -> Callable[[list[str]], list]:
    """Vectors from a service: ``{"model", "input"}`` in, ``{"data": [{"embedding"}]}`` out, in the order of the texts."""

    def embed(texts: list[str]) -> list:
        found = request(url, {"model": model, "input": texts}, token=token, timeout_s=timeout_s)
        return [x["embedding"] for x in found["data"]]

    return embed


def embed(
    df: DataFrame, text_col: str, embedder: Callable[[], Callable[[list[str]], list]], size: int, batch: int | str = 16, retry: Retry | None = None, out_col: str = "vector", at_once: int = 1, pause_s: float = 0.0
) -> DataFrame:
    """Adds ``out_col`` and ``skip_reason`` to every row.

    ``embedder`` makes the function inside the task. ``batch``: texts of a request, or the column that holds their number for a
    row (a request takes neighbours of one number). A task has ``at_once`` requests under way and begins one every
    ``pause_s`` seconds at most. A batch that is too long is tried text by text; the texts that are themselves too long get
    a null vector and a reason, other errors end the task.
    """
    at, tries = df.columns.index(text_col), retry or Retry()
    sizes = df.columns.index(batch) if isinstance(batch, str) else None
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.ArrayType(T.FloatType())), T.StructField("skip_reason", T.StringType())])

    def requests(whole: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        each = [batch] * len(whole) if sizes is None else whole.column(sizes).to_pylist()
        i = 0
        while i < len(whole):
            n = 1
            while n < (each[i] or 1) and i + n < len(whole) and each[i + n] == each[i]:
                n += 1
            yield i, n
            i += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, pace, last = embedder(), threading.Lock(), [0.0]

        def paced(texts: list[str]) -> list:
            with pace:
                time.sleep(max(0.0, last[0] + pause_s - time.monotonic()))
                last[0] = time.monotonic()
            return f(texts)

        def safely(texts: list[str]) -> list:
            try:
                return tries.call(paced, texts)
            except TooLong as e:
                return [e] if len(texts) == 1 else [v for t in texts for v in safely([t])]

        def asked(part: pa.RecordBatch) -> pa.RecordBatch:
            found = safely([t or "" for t in part.column(at).to_pylist()])
            wrong = [len(v) for v in found if not isinstance(v, TooLong) and len(v) != size]
            if wrong:
                raise ValueError(f"a vector of {wrong[0]} components where {size} are wanted")
            vectors = pa.array([None if isinstance(v, TooLong) else v for v in found], pa.list_(pa.float32()))
            reasons = pa.array([(str(v) or "too long") if isinstance(v, TooLong) else None for v in found], pa.string())
            return pa.RecordBatch.from_arrays([*part.columns, vectors, reasons], schema.names)

        with ThreadPoolExecutor(at_once) as pool:
            under_way: deque = deque()
            for whole in batches:
                for i, n in requests(whole):
                    under_way.append(pool.submit(asked, whole.slice(i, n)))
                    if len(under_way) >= at_once:
                        yield under_way.popleft().result()
            while under_way:
                yield under_way.popleft().result()

    return df.mapInArrow(run, schema)


def precomputed(df: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Vectors from a table with columns ``keys`` and ``vector``; rows without one get a reason."""
    out = df.join(vectors.select(*keys, "vector"), keys, "left")
    return out.withColumn("skip_reason", F.when(F.col("vector").isNull(), "no vector"))
