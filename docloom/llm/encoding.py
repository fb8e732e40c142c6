"""Operator 7: byte-level BPE encoding and decoding of whole texts.

A text longer than ``CHUNK`` is cut into overlapping chunks that are pre-tokenised in parallel. Chunk
k's pre-tokens are right from where the chunk before it hands over; chunk k+1 starts blindly. Where a
boundary of both falls together in their overlap, the pre-tokens from there on are the same, and the
text is cut there. A pair of chunks without a common boundary is not cut: both are in one piece. Chunks behind it
are right again from the first white space that follows another character in one of them, as no pre-token holds
such a place, so the text is cut again at the next common boundary. The pieces are encoded in parallel and joined in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import bpe

CHUNK, OVERLAP, ROWS_AT_ONCE = 1 << 15, 1 << 10, 256
#: Characters behind a pre-token that can decide where it ends (white space looks at one, a contraction at two).
LOOK = 4
#: A boundary wherever a search begins: no alternative of the pattern goes on from another character to white space.
CERTAIN = r"(?<=\S)(?=\s)"


def _encode(df: DataFrame, text_col: str, out_col: str, ranks: str) -> DataFrame:
    """Adds ``out_col``: the column ``text_col``'s ids as little-endian unsigned 32-bit integers; drops the text."""
    at = df.columns.index(text_col)
    schema = T.StructType([f for f in df.schema if f.name != text_col] + [T.StructField(out_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = bpe.by_ranks(ranks)
        for whole in batches:
            for i in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(i, ROWS_AT_ONCE)
                ids = [np.array(encoding.encode_ordinary(t or ""), dtype="<u4").tobytes() for t in batch.column(at).to_pylist()]
                kept = [c for k, c in enumerate(batch.columns) if k != at]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], schema.names)

    return df.mapInArrow(run, schema)


def _boundaries(df: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Pre-tokenises column ``text`` of each chunk ``k``; adds the starts of its pre-tokens, as places in
    the whole text, in its first (``head``) and last (``tail``) ``overlap`` characters, and the first boundary that is one whatever stands
    before the chunk (``sure``, null for none)."""
    columns = df.columns
    k_at, text_at = columns.index("k"), columns.index("text")
    schema = T.StructType([*df.schema.fields, T.StructField("head", T.ArrayType(T.LongType())), T.StructField("tail", T.ArrayType(T.LongType())), T.StructField("sure", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import regex

        pattern, certain = regex.compile(public_tokenizers.PATTERN), regex.compile(CERTAIN)
        kind = pa.list_(pa.int64())
        for whole in batches:
            for i in range(0, len(whole), 16):
                batch = whole.slice(i, 16)
                heads, tails, sure = [], [], []
                for k, text in zip(batch.column(k_at).to_pylist(), batch.column(text_at).to_pylist(), strict=True):
                    # A pre-token near the chunk's end may look otherwise with what follows. One that ends in white space may
                    # too if the text is cut behind it, so such boundaries are no cuts.
                    starts = [m.end() for m in pattern.finditer(text)]
                    starts = [s for s in starts if s < len(text) - LOOK and not text[s - 1].isspace()]
                    heads.append([k * chunk + s for s in starts if s < overlap])
                    tails.append([k * chunk + s for s in starts if chunk <= s])
                    first = certain.search(text)
                    sure.append(0 if not k else k * chunk + first.start() if first else None)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, kind), pa.array(tails, kind), pa.array(sure, pa.int64())], schema.names)

    return df.mapInArrow(run, schema)


def pieces_of(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``id, row, from, text``: the texts of ``long`` (``id, row, text``, longer than chunk and overlap) in pieces that are pre-tokenised as the whole text is."""
    # The last chunk begins where more than the overlap is left, so every chunk but the last has its whole overlap.
    count = F.ceil((F.length("text") - overlap) / chunk).cast("int")
    chunks = long.withColumn("k", F.explode(F.sequence(F.lit(0), count - 1))).withColumn("last", F.col("k") == count - 1)
    chunks = chunks.withColumn("text", F.substring("text", F.col("k") * chunk + 1, F.when(F.col("last"), F.length("text")).otherwise(F.lit(chunk + overlap))))
    marked = _boundaries(chunks.repartition("row", "k"), chunk, overlap)
    order = Window.partitionBy("row").orderBy("k")
    both = F.array_intersect("tail", F.lead("head").over(order))
    # A common boundary is right behind a certain one of either chunk; without such, if the chunk took over at a right one.
    certain = F.array_min(F.filter("both", lambda x: x >= F.col("from_here")))
    marked = marked.withColumn("both", both).withColumn("from_here", F.least("sure", F.lead("sure").over(order)))
    right = F.when(certain.isNotNull(), True).when(F.coalesce(F.size("both"), F.lit(0)) == 0, False)
    cut = marked.withColumn("common", F.coalesce(certain, F.array_min("both"))).withColumn("right", right)
    cut = cut.withColumn("right", F.coalesce(F.last("right", ignorenulls=True).over(order), F.lit(False)))
    # `end`: where chunk k hands over to chunk k+1; `begin`: where it takes over. Chunks that don't take over only bring the characters that those before them don't have.
    cut = cut.withColumn("end", F.when(F.col("right"), F.col("common"))).withColumn("begin", F.coalesce(F.lag("end").over(order), F.when(F.col("k") == 0, F.lit(0))))
    begin = F.coalesce("begin", F.col("k") * chunk)
    end = F.when(F.col("end").isNotNull(), F.col("end")).when(F.col("last"), F.col("k") * chunk + F.length("text")).otherwise((F.col("k") + 1) * chunk)
    parts = cut.select("id", "row", "k", F.when(F.col("begin").isNotNull(), F.col("k")).alias("from"), F.substring("text", (begin - F.col("k") * chunk + 1).cast("int"), (end - begin).cast("int")).alias("text"))
    parts = parts.withColumn("from", F.last("from", ignorenulls=True).over(order))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "")
    return parts.groupBy("row", "from").agg(F.first("id").alias("id"), joined.alias("text")).select("id", "row", "from", "text")


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``id, ids``: the ids of every whole text, little-endian unsigned 32-bit, one row per row of ``docs``.

    A null text counts as empty and has no ids. Null ids and repeated rows are kept as they are; an
    empty table gives no rows; further columns are not looked at. Texts may have any length; what is encoded at once
    is longer than two chunks only where a pre-token is longer than the overlap, or where no white space follows such a one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    short = _encode(rows.where(F.length("text") <= chunk + overlap), "text", "ids", ranks)
    long = rows.where(F.length("text") > chunk + overlap).withColumn("row", F.monotonically_increasing_id())
    coded = _encode(pieces_of(long, chunk, overlap).repartition("row", "from"), "text", "ids", ranks)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("from", F.hex("ids").alias("ids")))), lambda x: x["ids"])
    joined = coded.groupBy("row").agg(F.first("id").alias("id"), F.unhex(F.array_join(parts, "")).alias("ids"))
    return short.unionByName(joined.select("id", "ids")).withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks: str, ids_col: str = "ids", out_col: str = "bytes") -> DataFrame:
    """Adds ``out_col``: the bytes of each row's ids, joined. Null ids count as none."""
    at = df.columns.index(ids_col)
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = bpe.by_ranks(ranks)
        for whole in batches:
            for i in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(i, ROWS_AT_ONCE)
                found = [encoding.decode_bytes(np.frombuffer(x or b"", dtype="<u4").tolist()) for x in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], schema.names)

    return df.mapInArrow(run, schema)
