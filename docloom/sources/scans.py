"""Scans of a keyed table. Filters and columns reach the reader; a range is read in parallel, not page by page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, timeout_s: int = 120, **options: str) -> DataFrame:
    """A database table, read by ranges of its key: ``partitions`` connections at once, failed ones retried by Spark."""
    if partitions < 1 or upper <= lower:
        raise ValueError("a range of keys and at least one partition are needed")
    bounds = {"partitionColumn": key, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions, "queryTimeout": timeout_s}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **bounds, **options).load()


def point_lookup(df: DataFrame, key: str, value: int) -> DataFrame:
    return df.where(F.col(key) == value).limit(1)


def first_row(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(key).limit(1)


def keyset_page(df: DataFrame, key: str, after: int, rows: int, text: str | None = None) -> DataFrame:
    """The next ``rows`` rows behind ``after`` by key; with ``text``, those that have one."""
    if rows < 1:
        raise ValueError("a page needs at least one row")
    found = df.where(F.col(key) > after)
    return (found.where(F.col(text).isNotNull()) if text else found).orderBy(key).limit(rows)


def keyset_range(df: DataFrame, key: str, after: int, end: int, text: str | None = None, rows: int | None = None) -> DataFrame:
    """Rows with ``after < key <= end``; all of them, unordered, unless ``rows`` asks for a page."""
    if end <= after:
        raise ValueError("the range's end has to lie behind its start")
    found = df.where((F.col(key) > after) & (F.col(key) <= end))
    found = found.where(F.col(text).isNotNull()) if text else found
    return found.orderBy(key).limit(rows) if rows else found


def scroll(df: DataFrame, key: str, offset: int | None, rows: int, columns: list[str]) -> DataFrame:
    """A page of stored rows from key ``offset`` on, one row more than ``rows``: its key is the next offset."""
    found = df if offset is None else df.where(F.col(key) >= offset)
    return found.select(key, *columns).orderBy(key).limit(rows + 1)


def nonempty(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.col(text).isNotNull() & (F.col(text) != ""))


def ahead(df: DataFrame, key: str, cursor: int) -> DataFrame:
    """Rows behind the cursor; keys that are no numbers are left out."""
    return df.where(F.col(key).cast("string").try_cast("long") > cursor)


def raw_records(df: DataFrame, key: str = "file_name", kind: str = "ftype", html: str = "jtext", flag: str = "flag") -> DataFrame:
    """Source rows under the names that the parser takes; the key becomes 64-bit at once."""
    return df.select(F.col(key).cast("long").alias("file_name"), F.col(kind).alias("ftype"), F.col(html).alias("html"), F.col(flag).alias("flag"))


def changed(df: DataFrame, stored: str, computed: str) -> DataFrame:
    """Rows whose computed value is other than the stored one; null equals null."""
    return df.where(~F.col(stored).eqNullSafe(F.col(computed)))
