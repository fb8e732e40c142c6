"""Operator 1: shortest-pack-first packing over the length histogram.

Every text is encoded once. Its ids are cut into full sequences and a remainder; the remainders'
lengths make a histogram of at most ``size`` counts, which is all that packing looks at. Lengths are
placed longest first, each onto the least filled packing pattern with room, many documents at a time.
Pieces then find their sequence and offset by their rank among the pieces of their length.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import bpe, scratch

SIZE, END = 2048, 1
ROWS_AT_ONCE, BROADCAST_ROWS = 256, 300_000


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns ``(count, ((length, times), ...))`` whose lengths fill ``size`` at most.

    Longest lengths first; each goes to the shortest pack that has room (ties: the older one). A length
    splits one pattern and opens two at most, so there are at most ``3 * size``, however many documents.
    """
    packs: list[tuple[int, int, int, tuple]] = []  # (fill, age, count, lengths), shortest first
    age = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and packs and packs[0][0] + length <= size:
            fill, old, count, lengths = packs.pop(0)
            each = min((size - fill) // length, max(1, left // count))  # so many of this length on every pack of the pattern
            used = min(count, left // each)
            if used < count:
                insort(packs, (fill, old, count - used, lengths))
            age += 1
            insort(packs, (fill + each * length, age, used, (*lengths, (length, each))))
            left -= used * each
        for each in (size // length, left % (size // length)):
            if each and left >= each:
                age += 1
                insort(packs, (each * length, age, left // each, ((length, each),)))
                left %= each
    return [(count, lengths) for _, _, count, lengths in packs]


def layout(patterns: list[tuple[int, tuple[tuple[int, int], ...]]], first: int) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, from_rank, to_rank, first_sequence, each, offset)``: where the pieces of a length go, by rank."""
    rank: dict[int, int] = {}
    out = []
    for count, lengths in patterns:
        offset = 0
        for length, each in lengths:
            begin = rank.get(length, 0)
            rank[length] = begin + count * each
            out.append((length, begin, rank[length], first, each, offset))
            offset += each * length
        first += count
    return out


def pieces(docs: DataFrame, encode: Callable[[], bpe.PieceCache], id_col: str, text_col: str, size: int, end: int | None) -> DataFrame:
    """One row per piece: full sequences and the remainder of each document, with the ids.

    ``place`` counts the earlier pieces of the same length in the same partition ``part``.
    """
    tail = b"" if end is None else np.array([end], dtype="<u4").tobytes()
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "place")), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = encode(), Counter()
        for whole in batches:
            for at in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                rows = []
                for key, data in zip(batch.column(0).to_pylist(), cache.ids(batch.column(1).to_pylist()), strict=True):
                    data += tail
                    for i in range(0, len(data), 4 * size):
                        part = data[i : i + 4 * size]
                        rows.append((key, i // 4, len(part) // 4, len(data) // 4, seen[len(part)], part))
                        seen[len(part)] += 1
                kinds = [batch.schema.field(0).type, *[pa.int64()] * 4, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], schema.names)

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).mapInArrow(run, schema).withColumn("part", F.spark_partition_id())


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int | None = END) -> DataFrame:
    """Training sequences of at most ``size`` ids: one row per piece of a document.

    Columns: the id, ``start`` (its document's ids before it), ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``. A null text counts as empty; an empty
    text is the end id alone, or no piece without ``end``. Null ids and repeated rows are packed as they
    are. An empty table gives no rows. Further columns are not looked at.
    """
    spark = docs.sparkSession
    cut = scratch.keep(pieces(docs, lambda: bpe.by_tokenizers(vocabulary), id_col, text_col, size, end))
    # A piece's rank within its length: its place in its partition and the counts of the partitions before it, so that a
    # length's pieces are never brought together.
    groups = scratch.keep(cut.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    if groups.count() <= BROADCAST_ROWS:  # else a shuffle by (part, length), groups no larger than a partition
        starts = F.broadcast(starts)
    full = counts.pop(size, 0)
    table = [(size, 0, full, 0, 1, 0), *layout(pack_histogram(counts, size), full)]
    # Slots: each pattern has at most 64 different lengths, so at most 192 * size rows.
    slots = spark.createDataFrame(table, "length long, from_rank long, to_rank long, first_sequence long, each long, at long")
    rank = F.col("place") + F.col("before")
    seat = F.col("rank") - F.col("from_rank")
    return (
        cut.join(starts, ["part", "length"])
        .withColumn("rank", rank)
        .join(F.broadcast(slots), "length")
        .where((F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
        .select(
            F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens",
            (F.col("first_sequence") + F.floor(seat / F.col("each"))).alias("sequence_id"),
            (F.col("at") + F.col("length") * F.pmod(seat, F.col("each"))).alias("offset"),
        )
    )
