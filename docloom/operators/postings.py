"""An inverted index kept by additions: what a change adds counts positively, what it replaces or deletes negatively.

Rows are ``term, id, tf, dl`` with the sign in ``tf`` and ``dl``; a row without a term and id holds a change's net
number of texts (``tf``) and words (``dl``). Folders: ``batch=<change>/bucket=<hash of the term>``, so a query reads the
buckets of its terms alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.search import B, K1, bm25_score, query_terms, tokens

BUCKETS, TOTALS = 64, -1
#: Stored bytes of texts whose words one task brings together, and those worth a task while cores are left.
TASK_BYTES, LEAST_BYTES = 32 << 20, 1 << 20
SCHEMA = "term string, id long, tf long, dl long, batch string, bucket int"


def bucket(term: Column | str) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def delta(key: str, text: str, fresh: DataFrame | None, gone: DataFrame | None, size: int = 0) -> DataFrame:
    """What a change adds: the words of its ``fresh`` rows, less those of the rows that are ``gone`` (one row a key in each), netted by
    term and id: what is gone has none; a term that stands as often in a longer text keeps the new length. ``size``: the texts' bytes.

    Texts are dealt out by key before they are split, as words take several times their room, and words are counted where
    their texts are. A text is split once: its words and one null, which counts the text itself.
    """
    parts = []
    for df, sign in ((fresh, 1), (gone, -1)):
        if df is not None:
            parts.append(df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.lit(sign).alias("sign")))
    slots = 1 + max(size // TASK_BYTES, min(size // LEAST_BYTES, parts[0].sparkSession.sparkContext.defaultParallelism - 1))
    dealt = reduce(DataFrame.union, parts).withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int")).repartitionById(slots, F.col("slot"))
    split = lambda w: F.struct(F.size(w).alias("dl"), F.concat(w, F.array(F.lit(None).cast("string"))).alias("terms"))
    found = dealt.select("slot", "id", "sign", F.explode(F.transform(F.array(tokens("text")), split)).alias("c"))
    words = found.select("slot", "id", "sign", F.col("c.dl").alias("dl"), F.explode("c.terms").alias("term"))
    words = words.select("slot", "term", F.when(F.col("term").isNotNull(), F.col("id")).alias("id"), "dl", "sign")
    longest = lambda sign: F.coalesce(F.max(F.when(F.col("sign") == sign, F.col("dl"))), F.lit(0))
    length = F.when(F.col("term").isNull(), F.sum(F.col("sign") * F.col("dl"))).otherwise(longest(1) - longest(-1))
    return _placed(words.groupBy("slot", "term", "id").agg(F.sum("sign").alias("tf"), length.cast("long").alias("dl"))).sortWithinPartitions("bucket", "term", "id")


def _placed(rows: DataFrame) -> DataFrame:
    """Additions with their bucket."""
    at = F.when(F.col("term").isNull(), TOTALS).otherwise(bucket("term")).cast("int")
    return rows.select("term", "id", "tf", "dl", at.alias("bucket")).where("tf <> 0 OR dl <> 0")


def write(rows: DataFrame, folder: str) -> None:
    """Additions of all batches, each bucket brought together."""
    _placed(rows).hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "id").write.partitionBy("bucket").parquet(folder)


def netted(index: DataFrame) -> DataFrame:
    return index.groupBy("term", "id").agg(F.sum("tf").alias("tf"), F.sum("dl").alias("dl"))


def bm25_topk(index: DataFrame, query: str, k: int = 20, k1: float = K1, b: float = B) -> DataFrame:
    """``id, score`` as by a scan of the texts, from the postings of the query's terms alone."""
    terms = query_terms(index.sparkSession, query)
    values = index.sparkSession.createDataFrame([(t,) for t in terms], "t string").select("t", bucket("t").alias("b")).collect()
    own = index.where(F.col("bucket").isin([r.b for r in values]) & F.col("term").isin(terms))
    tf = [F.sum(F.when(F.col("term") == t, F.col("tf")).otherwise(0)).alias(f"tf{i}") for i, t in enumerate(terms)]
    dl = F.max("dl").alias("dl")
    live = netted(own).where("tf > 0")
    texts = live.groupBy("id").agg(dl, *tf).select("id", "dl", F.array(*(f"tf{i}" for i in range(len(terms)))).alias("tf"))
    held = [F.count_if(F.get("tf", F.lit(i)) > 0).alias(f"df{i}") for i in range(len(terms))]
    totals = index.where(F.col("bucket") == TOTALS).agg(F.sum("tf").alias("n"), (F.sum("dl") / F.sum("tf")).alias("avgdl"))
    stats = texts.agg(*held).crossJoin(totals)  # one row each
    return bm25_score(texts.crossJoin(F.broadcast(stats)), len(terms), k1, b).orderBy(F.desc("score"), "id").limit(k)
