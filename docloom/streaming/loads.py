"""Resumable loads: new files of a source folder go through parsing and chunking into a collection.

Progress is the stream's checkpoint and the collection's ledger: a batch is written under the stream's own name and
number, so one that is repeated after a failure finds itself in the ledger and changes nothing. ``Progress`` keeps the range-job form of the same thing for callers that have one.
"""

from __future__ import annotations

import json
import os
import signal
import threading
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from threading import Event

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from docloom.functions import text as X
from docloom.operators.chunk import chunk
from docloom.operators.parse import CASE_COLUMNS, JUDGMENT, Profile, parse_cases
from docloom.operators.points import points
from docloom.operators.store import Collection
from docloom.sources.files import Files
from docloom.sources.scans import nonempty


def load(raw: DataFrame, embed: Callable[[DataFrame], DataFrame] | None = None, profile: Profile = JUDGMENT, target_words: int = 600, overlap: int = 1) -> DataFrame:
    """Raw rows as points: parse, chunk, embed (adds ``vector`` and ``skip_reason``). Nothing is shuffled or computed twice."""
    cases = parse_cases(nonempty(raw, "html"), profile)
    chunks = chunk(cases, "case_id", "paragraphs", target_words, overlap, [c for c in CASE_COLUMNS if c != "case_id"])
    return points(embed(chunks) if embed else chunks)


def counters(points: DataFrame) -> dict:
    """What a batch has written, for the ledger: cases, chunks, and their size as JSON."""
    row = points.agg(F.countDistinct("case_id").alias("cases"), F.count("*").alias("chunks"), F.coalesce(F.sum(X.json_bytes(*points.columns)), F.lit(0)).alias("bytes")).first()
    return row.asDict()


def stream_load(spark: SparkSession, source: str, collection: Collection, checkpoint: str, after: int | None = None, end: int | None = None, files_at_once: int = 100, stop: Event | None = None, rows: DataFrame | None = None, **options) -> StreamingQuery:
    """Loads what is new in ``source`` (Parquet with ``file_name, ftype, html, flag``), or in the stream ``rows``, and stops; run it again for more.

    ``after`` and ``end`` restrict the keys to ``(after, end]``. Once ``stop`` is set, the batch that runs is the last one.
    """
    if rows is None:
        schema = spark.read.parquet(source).schema
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    if after is not None:
        rows = rows.where(F.col("file_name") > after)
    if end is not None:
        rows = rows.where(F.col("file_name") <= end)
    metadata = Files(spark, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        if stop is not None and stop.is_set():
            raise Stopped("asked to stop between batches")
        begun = time.time()
        name = f"{metadata.read('metadata')['id']}-{number}"  # the stream's own id, which its checkpoint keeps

        def count(points: DataFrame) -> dict:
            return counters(points) | {"begun": begun, "seconds": time.time() - begun}

        collection.upsert(load(batch, **options), batch=name, count=count)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Stopped(Exception):
    """A load was asked to stop; what it has written stays, and the next run goes on behind it."""


def run_load(*args, **options) -> dict:
    """``stream_load`` to its end, or to the end of the running batch at SIGINT or SIGTERM; returns the collection's totals."""
    stop = options.pop("stop", None) or Event()
    before = {}
    if threading.current_thread() is threading.main_thread():
        before = {s: signal.signal(s, lambda *_: stop.set()) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        stream_load(*args, stop=stop, **options).awaitTermination()
    except StreamingQueryException:
        if not stop.is_set():
            raise
    finally:
        for s, handler in before.items():
            signal.signal(s, handler)
    return totals(args[2] if len(args) > 2 else options["collection"])


def totals(collection: Collection) -> dict:
    """Sums over the ledger, each batch once, and rates per minute of the time that batches took (0.001 minutes at least)."""
    own = [x for x in collection.ledger() if "cases" in x]
    out = {c: sum(x[c] for x in own) for c in ("cases", "chunks", "bytes")} | {"batches": len(own)}
    minutes = max(sum(x["seconds"] for x in own) / 60, 0.001)
    return out | {"minutes": minutes, "cases_per_minute": out["cases"] / minutes, "chunks_per_minute": out["chunks"] / minutes}


class Rates(StreamingQueryListener):
    """Rows and rows per minute of every micro-batch of the session's streams, as they end."""

    def __init__(self) -> None:
        self.batches: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        minutes = max(p.durationMs.get("triggerExecution", 0) / 60_000, 0.001)
        self.batches.append({"query": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "minutes": minutes, "rows_per_minute": p.numInputRows / minutes, "at": p.timestamp})

    def onQueryTerminated(self, event) -> None:
        pass


@dataclass(frozen=True)
class Progress:
    worker: str
    after: int
    end: int
    cursor: int
    cases: int = 0
    chunks: int = 0

    def valid_for(self, worker: str, after: int, end: int) -> bool:
        """Whether a run over ``(after, end]`` may go on from here; a finished range begins anew."""
        return (self.worker, self.after, self.end) == (worker, after, end) and after <= self.cursor < end and self.cases >= 0 and self.chunks >= 0

    def save(self, path: str) -> None:
        with open(f"{path}.new", "w") as f:
            json.dump(asdict(self), f)
        os.replace(f"{path}.new", path)

    @staticmethod
    def read(path: str) -> Progress | None:
        """None for a missing or broken file."""
        try:
            with open(path) as f:
                return Progress(**json.load(f))
        except (OSError, ValueError, TypeError):
            return None


def event_windows(events: DataFrame, minutes: int = 60, late: str = "1 hour") -> DataFrame:
    """Counts by event type in tumbling windows of event time; rows later than ``late`` are dropped by a stream."""
    windowed = events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type")
    return windowed.agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("value")).select(F.col("window.start").alias("start"), "event_type", "events", "value")
