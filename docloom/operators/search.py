"""Ranked retrieval: exact dense top-k, BM25, reciprocal-rank fusion. Scores are ranked as rounded to six
places, ties by id, so that a result doesn't depend on the order of summation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\p{L}\p{N}]+"
K1, B, RRF_K = 1.2, 0.75, 60


def query_text(parts: list[str]) -> str:
    """The words of a command line as one query."""
    if not (text := " ".join(parts).strip()):
        raise ValueError("a query needs a text")
    return text


def inner_product(one: Column, two: Column) -> Column:
    return F.aggregate(F.zip_with(one, two, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def cosine(one: Column | str, two: Column | str) -> Column:
    """Null for a null or zero vector."""
    a, b = ((F.col(c) if isinstance(c, str) else c).cast("array<double>") for c in (one, two))
    norms = F.sqrt(inner_product(a, a) * inner_product(b, b))
    return F.when(norms > 0, inner_product(a, b) / norms)


def dense_topk(df: DataFrame, query: list[float], k: int = 5, id_col: str = "id", vector_col: str = "dense") -> DataFrame:
    """``id, score``: one pass over the vectors, the query a literal, then a bounded top-k.

    Vectors that are null or zero, of another length than the query's, or without finite components take no part.
    """
    own = df.where(F.size(vector_col) == len(query))
    scored = own.select(F.col(id_col).alias("id"), F.round(cosine(vector_col, F.lit([float(x) for x in query])), 6).alias("score"))
    return scored.where("score IS NOT NULL AND NOT isnan(score)").orderBy(F.desc("score"), "id").limit(k)


def tokens(text: Column | str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), WORD), lambda t: t != "")


def postings(df: DataFrame, id_col: str = "id", text_col: str = "sparse_text") -> DataFrame:
    """``id, term, tf, dl``: the inverted index as a table."""
    words = df.select(F.col(id_col).alias("id"), tokens(text_col).alias("words"))
    return words.select("id", F.size("words").alias("dl"), F.explode("words").alias("term")).groupBy("id", "term", "dl").agg(F.count("*").alias("tf")).select("id", "term", "tf", "dl")


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """A query's distinct words, sorted."""
    terms = sorted({t for t in spark.range(1).select(tokens(F.lit(query)).alias("t")).first().t})
    if not terms:
        raise ValueError("a query needs a word")
    return terms


def bm25_score(df: DataFrame, terms: int, k1: float = K1, b: float = B) -> DataFrame:
    """``id, score`` of rows ``id, dl, tf`` (by term), ``n, avgdl`` and ``df0, df1 ...``."""
    parts = []
    for i in range(terms):
        n, held, times = F.col("n"), F.col(f"df{i}"), F.get("tf", F.lit(i))
        idf = F.log(F.lit(1.0) + (n - held + F.lit(0.5)) / (held + F.lit(0.5)))
        parts.append(idf * times * F.lit(k1 + 1) / (times + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / F.col("avgdl"))))
    return df.select("id", F.round(reduce(Column.__add__, parts), 6).alias("score"))


def bm25_topk(df: DataFrame, query: str, k: int = 20, id_col: str = "id", text_col: str = "sparse_text", k1: float = K1, b: float = B) -> DataFrame:
    """``id, score`` of the texts with a term of the query.

    Only the query's terms are counted, within each text, so no posting is shuffled: document frequencies
    and the average length are one aggregation, the scores a projection behind it.
    """
    terms = query_terms(df.sparkSession, query)
    words = df.select(F.col(id_col).alias("id"), tokens(text_col).alias("words"))
    # Made a row of its own, else each later use of a count and each filter would split the texts again.
    counted = words.select("id", F.explode(F.transform(F.array("words"), lambda w: F.struct(F.size(w).alias("dl"), F.array(*(_times(w, t) for t in terms)).alias("tf")))).alias("c")).select("id", "c.*")
    found = [F.count_if(F.get("tf", F.lit(i)) > 0).alias(f"df{i}") for i in range(len(terms))]
    stats = counted.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *found)
    scored = counted.where(F.exists("tf", lambda x: x > 0)).crossJoin(F.broadcast(stats))  # one row
    return bm25_score(scored, len(terms), k1, b).orderBy(F.desc("score"), "id").limit(k)


def _times(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == term))


def rrf(lists: list[DataFrame], k: int = 10, constant: int = RRF_K) -> DataFrame:
    """``id, score`` fused from ranked lists (``id, score``), which are short."""
    order = Window.orderBy(F.desc("score"), "id")
    ranked = [x.select("id", (1.0 / (constant + F.row_number().over(order))).alias("part")) for x in lists]
    both = reduce(DataFrame.unionByName, ranked)
    return both.groupBy("id").agg(F.round(F.sum("part"), 6).alias("score")).orderBy(F.desc("score"), "id").limit(k)


def hybrid_search(df: DataFrame, query: str, vector: list[float], k: int = 10, prefetch: int = 20, characters: int = 1800, id_col: str = "id", vector_col: str = "dense", text_col: str = "sparse_text") -> DataFrame:
    """Fused BM25 and dense search; the result's columns are those of ``df``, with ``score`` and a text prefix."""
    fused = rrf([bm25_topk(df, query, prefetch, id_col, text_col), dense_topk(df, vector, prefetch, id_col, vector_col)], k)
    return shown(df, fused, characters, id_col)


def shown(df: DataFrame, found: DataFrame, characters: int, id_col: str = "id") -> DataFrame:
    """Payload of the few rows found, best first; the text cut to a prefix."""
    names = [c for c in ("case_id", "title", "citation", "chunk_id", "paragraph_start", "paragraph_end") if c in df.columns]
    both = df.withColumnRenamed(id_col, "id").join(F.broadcast(found), "id")  # at most k rows
    return both.select("score", "id", *names, F.substring(F.coalesce("text", F.lit("")), 1, characters).alias("text")).orderBy(F.desc("score"), "id")
