"""Points: a passage with its id, vector, sparse text and the payload of its case."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as X
from docloom.operators.parse import CASE_COLUMNS

CHUNK_COLUMNS = ["chunk_id", "chunk_index", "paragraph_start", "paragraph_end", "word_count", "has_subpoints", "source_paragraph_types", "text"]


def points(chunks: DataFrame) -> DataFrame:
    """``id, sparse_text`` and the payload columns of passages that carry their case's columns; ``chunks`` may bring
    ``vector`` and ``skip_reason``. Skipped passages are left out, and so are cases with no other."""
    kept = chunks.where(F.col("skip_reason").isNull()) if "skip_reason" in chunks.columns else chunks
    vector = [F.col("vector").alias("dense")] if "vector" in chunks.columns else []
    return kept.select(X.point_id("case_id", "chunk_index").alias("id"), *vector, X.sparse_text("text").alias("sparse_text"), *CASE_COLUMNS, *CHUNK_COLUMNS)


def batches(df: DataFrame, group: str, order: str, most_bytes: int = 8 << 20, most_points: int = 25) -> DataFrame:
    """Adds ``batch``: greedy write batches within each case, of so many points and JSON bytes at most.

    A point over the limit is a batch of its own. Only ids and sizes go to the workers, sorted within their
    partition; a worker holds the running batch's size and count alone, so a case may have any number of points.
    """
    sized = df.select(F.col(group).alias("g"), F.col(order).alias("o"), X.json_bytes(*df.columns).alias("bytes"))
    kinds = dict(sized.dtypes)

    def fold(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        case, batch, used, count = object(), 0, 0, 0
        for table in tables:
            out = []
            for g, size in zip(table.column(0).to_pylist(), table.column(2).to_pylist(), strict=True):
                if g != case:
                    case, batch, used, count = g, 0, 0, 0
                elif used + size > most_bytes or count >= most_points:
                    batch, used, count = batch + 1, 0, 0
                used, count = used + size, count + 1
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*table.columns, pa.array(out, pa.int64())], ["g", "o", "bytes", "batch"])

    ordered = sized.select("g", "o", F.col("bytes").cast("long")).repartition("g").sortWithinPartitions("g", "o")
    found = ordered.mapInArrow(fold, f"g {kinds['g']}, o {kinds['o']}, bytes long, batch long")
    return found.select(F.col("g").alias(group), F.col("o").alias(order), "bytes", "batch")
