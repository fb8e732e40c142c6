"""Tables written to the shared checkpoint folder to cut lineage.

A written table is computed once (``DataFrame.checkpoint`` computes its plan twice) and survives
the loss of executors, because every executor and the driver can read the folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark deletes a query's shuffle files at its end, not only once the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to a Python worker, and come back, at once.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_open: list[list[DataFrame]] = []


def folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def keep(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, with the same schema.

    ``batch_rows``: of rows with long texts, so many at most are held at once by a Python worker and in the buffers to and from it.
    """
    spark = df.sparkSession
    path, before = f"{folder(spark)}/docloom-{uuid.uuid4().hex}", {CLEANUP: spark.conf.get(CLEANUP, "false")}
    if batch_rows:
        before[BATCH_ROWS] = spark.conf.get(BATCH_ROWS)
        spark.conf.set(BATCH_ROWS, batch_rows)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    out = spark.read.schema(df.schema).parquet(path)
    out._docloom_path = path
    if _open:
        _open[-1].append(out)
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by ``keep`` once nothing reads it any more."""
    remove(df.sparkSession, df._docloom_path)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables kept within the block are deleted at its end, but for those given to the yielded function.

    Only what the returned plan reads has to be given to it.
    """
    own: list[DataFrame] = []
    left: list[DataFrame] = []

    def leave(df: DataFrame) -> DataFrame:
        left.append(df)
        return df

    _open.append(own)
    try:
        yield leave
    finally:
        _open.pop()
        for df in own:
            if not any(df is x for x in left):
                drop(df)  # nothing happens where it is gone already
        if _open:
            _open[-1].extend(left)
