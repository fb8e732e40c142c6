"""The commands: create, load, search, backfill and preview, each one function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.config import Config
from docloom.functions.text import SERIALS, adaptive_batch
from docloom.operators import backfill, postings
from docloom.operators.chunk import chunk
from docloom.operators.embed import embed, hashing_embedder, http_embedder
from docloom.operators.parse import CASE_COLUMNS, parse_cases
from docloom.operators.points import CHUNK_COLUMNS
from docloom.operators.search import bm25_topk, query_text, rrf, shown
from docloom.operators.store import Collection
from docloom.operators.vector_index import vector_topk
from docloom.sources import scans
from docloom.streaming.loads import load

LISTS = {"judges", "acts_referred", "equivalent_citations", "advocates", "source_paragraph_types"}
NUMBERS = {"case_id": "bigint", "file_name": "bigint", "flag": "int", "cited": "double", "chunk_index": "int", "paragraph_start": "int", "paragraph_end": "int", "word_count": "int", "has_subpoints": "boolean"}


def point_schema(dense: bool = True) -> T.StructType:
    kind = lambda c: NUMBERS.get(c) or ("array<string>" if c in LISTS else "string")
    columns = [("id", "bigint"), *([("dense", "array<float>")] if dense else []), ("sparse_text", "string"), *((c, kind(c)) for c in [*CASE_COLUMNS, *CHUNK_COLUMNS])]
    return T._parse_datatype_string(", ".join(f"{n} {k}" for n, k in columns))


#: Keys of a hundred cases are one partition, so that loads of new cases leave the older ones alone.
CASES_TOGETHER = 100


def create_collection(spark: SparkSession, path: str) -> Collection:
    """A collection for dense search."""
    collection = Collection(spark, path, width=CASES_TOGETHER * SERIALS)
    collection.ensure(point_schema())
    return collection


def create_hybrid_collection(spark: SparkSession, path: str) -> Collection:
    """A collection with an inverted index of the sparse texts beside its vectors."""
    collection = Collection(spark, path, width=CASES_TOGETHER * SERIALS, text="sparse_text")
    collection.ensure(point_schema())
    return collection


def ingest(
    raw: DataFrame, collection: Collection, after: int, end: int | None = None, rows: int | None = None, size: int = 64, target_words: int = 600, embedder: Callable[[], Callable[[list[str]], list]] | None = None, **requests
) -> None:
    """Loads the range ``(after, end]``, or the next ``rows`` rows, into a collection.

    ``embedder`` makes the function of texts, such as ``lambda: http_embedder(url, model)``; without one it is the hashing stand-in.
    A case's number of passages sets the texts of a request; ``requests`` (``at_once``, ``pause_s``, ``retry``) go to ``embed``.
    """
    page = scans.keyset_range(raw, "file_name", after, end, "html", rows) if end is not None else scans.keyset_page(raw, "file_name", after, rows or 10, "html")
    make = embedder or (lambda: hashing_embedder(size))

    def vectors(chunks: DataFrame) -> DataFrame:
        sized = chunks.withColumn("docloom_texts", adaptive_batch("chunk_count"))
        return embed(sized, "text", make, size, "docloom_texts", **requests).drop("docloom_texts")

    collection.upsert(load(page, vectors, target_words=target_words))


def source(spark: SparkSession, config: Config, after: int, end: int) -> DataFrame:
    """The configured table's rows; a database is read by ranges of the keys ``(after, end]``, as many at once as pages of the range."""
    if config.jdbc_url is None:
        return scans.raw_records(spark.read.parquet(config.table))
    given = {"user": config.jdbc_user, "password": config.jdbc_password, "driver": config.jdbc_driver}
    ranges = max(1, min(64, (end - after) // config.page_rows))
    return scans.raw_records(scans.read_jdbc(spark, config.jdbc_url, config.table, "file_name", after, end, ranges, **{k: v for k, v in given.items() if v}))


def load_range(spark: SparkSession, config: Config, after: int, end: int) -> Collection:
    """The configured range load: source, collection, passages and vectors."""
    collection = create_hybrid_collection(spark, config.required("collection").collection)
    url, model, token = config.embedding_url, config.embedding_model, config.embedding_token
    embedder = (lambda: http_embedder(url, model, token)) if url else None
    ingest(source(spark, config, after, end), collection, after, end, size=config.vector_size, target_words=config.chunk_words, embedder=embedder)
    return collection


def search(collection: Collection, words: list[str], size: int = 64, k: int = 5) -> DataFrame:
    """The best rows by vector; by the collection's vector index where it has one."""
    found = vector_topk(collection, hashing_embedder(size)([query_text(words)])[0].tolist(), k)
    return payload(collection, found, 1500)


def hybrid(collection: Collection, words: list[str], size: int = 64, k: int = 10, prefetch: int = 20) -> DataFrame:
    """Vector search and BM25, fused; BM25 by the stored postings where the collection has them."""
    text = query_text(words)
    sparse = postings.bm25_topk(collection.postings(), text, prefetch) if collection.text else bm25_topk(collection.read(collection.key, "sparse_text"), text, prefetch)
    return payload(collection, rrf([sparse, vector_topk(collection, hashing_embedder(size)([text])[0].tolist(), prefetch)], k), 1800)


def payload(collection: Collection, found: DataFrame, characters: int) -> DataFrame:
    """The found rows (a few) with what a reader wants to see; only their partitions are read."""
    rows = found.collect()
    few = found.sparkSession.createDataFrame(rows, found.schema)
    return shown(collection.of_keys([r.id for r in rows]), few, characters, collection.key)


def backfill_court_ids(collection: Collection) -> DataFrame:
    """Writes the court ids that change, and indexes them; returns the summary."""
    df = collection.read()
    found = backfill.court_ids(df if "court_id" in df.columns else df.withColumn("court_id", F.lit(None).cast("long")))
    counts = found.sparkSession.createDataFrame(backfill.summary(found).collect())
    collection.set_payload(found.where("class = 'updated'").select(collection.key, F.col("computed").alias("court_id")))
    collection.create_index("court_id")
    return counts


def backfill_decision_dates(collection: Collection) -> DataFrame:
    """Indexes decision years and writes the dates and years that change; returns the summary."""
    df = collection.read()
    for name, kind in (("decision_date", "date"), ("decision_year", "int")):
        df = df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))
    found = backfill.decision_dates(df)
    counts = found.sparkSession.createDataFrame(backfill.summary(found).collect())
    for name in ("decision_date", "decision_year"):
        collection.create_index(name)
    collection.set_payload(found.where("class = 'updated'").select(collection.key, "computed.decision_date", "computed.decision_year"))
    return counts


def preview(raw: DataFrame, case_id: int | None = None, paragraphs: int = 500, chunks: int = 25) -> dict[str, DataFrame]:
    """One case (the first without an id) parsed and chunked, in the sizes that a reader looks at."""
    row = scans.first_row(raw, "file_name") if case_id is None else scans.point_lookup(raw, "file_name", case_id)
    case = parse_cases(row)
    return {"case": case.withColumn("paragraphs", F.slice("paragraphs", 1, paragraphs)), "chunks": chunk(case).where(F.col("chunk_index") < chunks)}
