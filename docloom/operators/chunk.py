"""Overlapping passages of a bounded number of words. The greedy fold is sequential within a document, so it
runs in Arrow batches over whole documents; documents are independent and nothing is shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import text as X

SPACES = re.compile(r"[\s﻿]+")
FIELDS = [
    ("chunk_id", T.StringType()), ("chunk_index", T.IntegerType()), ("paragraph_start", T.IntegerType()), ("paragraph_end", T.IntegerType()), ("text", T.StringType()),
    ("word_count", T.IntegerType()), ("has_subpoints", T.BooleanType()), ("source_paragraph_types", T.ArrayType(T.StringType())),
    ("chunk_count", T.IntegerType()),
]


def line_paragraphs(text: Column | str) -> Column:
    """A plain text's non-empty lines as paragraphs."""
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n"), lambda t: X.normalize_inline(t)), lambda t: t != "")
    row = lambda t: F.struct(F.lit(None).cast("long").alias("para_no"), t.alias("text"), F.lit("judgpara").alias("source_class"), F.lit("main").alias("role"))
    return F.transform(lines, row)


def split_long(paragraphs: list[dict], most: int) -> Iterator[tuple[int, dict, str]]:
    """``(words, paragraph, text)``: paragraphs over ``most`` words in windows of so many."""
    for p in paragraphs:
        words = [w for w in SPACES.split(p["text"] or "") if w]
        if len(words) <= most:
            yield len(words), p, p["text"] or ""
        else:
            for i in range(0, len(words), most):
                yield len(part := words[i : i + most]), p, " ".join(part)


def spans(weights: list[int], most: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Greedy windows ``[start, end)``: one paragraph at least, then as long as the sum stays within ``most``."""
    start, n = 0, len(weights)
    while start < n:
        end, total = start + 1, weights[start]
        while end < n and total + weights[end] <= most:
            total += weights[end]
            end += 1
        yield start, end
        if end == n:
            return
        start = max(end - overlap, start + 1)


def chunk(df: DataFrame, id_col: str = "case_id", paragraphs: str = "paragraphs", target_words: int = 900, overlap: int = 1, carry: list[str] | None = None) -> DataFrame:
    """One row per passage: the id, ``chunk_id`` to ``chunk_count`` (of its document), and the document's columns ``carry``.

    ``paragraph_start`` and ``paragraph_end`` count, from 1, the paragraphs after long ones are split. A
    document without paragraphs gives no rows.
    """
    if target_words < 1 or overlap < 0:
        raise ValueError("target_words has to be positive and overlap not negative")
    carry = carry or []
    schema = T.StructType([df.schema[id_col], *(T.StructField(n, t) for n, t in FIELDS), *(df.schema[c] for c in carry)])
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.string()), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 128):
                batch = whole.slice(at, 128)
                rows, origin = [], []
                for row, (key, found) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                    parts = list(split_long(found or [], target_words))
                    found = list(spans([p[0] for p in parts], target_words, overlap))
                    for i, (start, end) in enumerate(found):
                        own = parts[start:end]
                        text = "\n\n".join(t if p["para_no"] is None else f"[{p['para_no']}] {t}" for _, p, t in own).strip()
                        roles = list(dict.fromkeys(p["role"] for _, p, _ in own))
                        rows.append((key, f"{key}_{i}", i, start + 1, end, text, sum(p[0] for p in own), "subpoint" in roles, roles, len(found)))
                        origin.append(row)
                first = pa.array([r[0] for r in rows], batch.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([first, *(pa.array([r[k + 1] for r in rows], kind) for k, kind in enumerate(kinds)), *(c.take(pa.array(origin, pa.int64())) for c in batch.columns[2:])], schema.names)

    return df.select(id_col, paragraphs, *carry).mapInArrow(run, schema)


def totals(chunks: DataFrame, id_col: str = "case_id") -> DataFrame:
    """``cases, chunks`` of a run: cases without a passage don't count."""
    return chunks.agg(F.countDistinct(id_col).alias("cases"), F.count("*").alias("chunks"))


def large_cases(chunks: DataFrame, id_col: str = "case_id", over: int = 300) -> DataFrame:
    """Cases with more than ``over`` passages."""
    return chunks.groupBy(id_col).agg(F.count("*").alias("chunks")).where(F.col("chunks") > over)
