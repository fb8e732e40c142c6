"""Remote tables as Spark data sources: pages by key out of a service, write batches of bounded size into one.

``spark.dataSource.register(KeyedPages)`` gives ``format("keyed_pages")`` for batch and stream reads, ``PointBatches``
``format("point_batches")`` for writes. The services speak JSON:

- ``GET <url>?after=&end=&limit=``: rows with ``after < key <= end``, by key; ``GET <url>?last=1``: ``{"key": ...}``, the last key
- ``POST <url>/staged/<write>/<part>``: ``{"batch": n, "points": [...]}``; ``POST <url>/commit/<write>``: ``{"parts": [...]}``;
  ``DELETE <url>/staged/<write>``, behind which the service refuses further batches of that write (a task may still run)
"""

from __future__ import annotations

import datetime
import json
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from docloom.sources.http import PAGES, Retry, request

RAW = "file_name long, ftype string, jtext string, flag int"


def _retry(options: dict) -> Retry:
    return replace(PAGES, attempts=int(options.get("retries", PAGES.attempts)), base_s=float(options.get("retry_s", PAGES.base_s)), busy_s=float(options.get("retry_s", PAGES.busy_s)))


@dataclass
class Keys(InputPartition):
    after: int
    end: int


class _Pages:
    """A range of keys is read page by page, each page with its retries; what is held is one page."""

    def __init__(self, schema: StructType, options: dict):
        self.names, self.options, self.retry = schema.names, dict(options), _retry(options)
        self.url, self.key, self.rows = options["url"], options.get("key", schema.names[0]), int(options.get("page_rows", 100))
        self.ranges = int(options.get("ranges", 8))
        if self.rows < 1 or self.ranges < 1:
            raise ValueError("a page and a range at least are needed")

    def get(self, **query: int):
        asked = f"{self.url}?{urllib.parse.urlencode(query)}"
        return self.retry.run(lambda: request(asked, token=self.options.get("token"), timeout_s=float(self.options.get("timeout_s", 120))))

    def split(self, after: int, end: int) -> list[Keys]:
        cuts = [after + (end - after) * k // self.ranges for k in range(self.ranges + 1)]
        return [Keys(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]

    def read(self, partition: Keys | None) -> Iterator[tuple]:
        if partition is None:  # no range at all
            return
        at = partition.after
        while found := self.get(after=at, end=partition.end, limit=self.rows):
            for row in found:
                if not at < row[self.key] <= partition.end:
                    raise ValueError(f"key {row[self.key]} behind {at}: the source doesn't go forward")
                at = row[self.key]
                yield tuple(row.get(n) for n in self.names)


class _Batch(_Pages, DataSourceReader):
    def partitions(self) -> list[Keys]:
        end = int(self.options["end"]) if "end" in self.options else self.get(last=1)["key"]
        after = int(self.options.get("after", -1))
        if "end" in self.options and end <= after:
            raise ValueError("the range's end has to lie behind its start")
        return self.split(after, end)


class _Stream(_Pages, DataSourceStreamReader):
    """Offsets are keys, so a batch that is repeated reads the same range."""

    def initialOffset(self) -> dict:
        return {"key": int(self.options.get("after", -1))}

    def latestOffset(self) -> dict:
        last = self.get(last=1)["key"]
        return {"key": max(min(last, int(self.options["end"])) if "end" in self.options else last, self.initialOffset()["key"])}

    def partitions(self, start: dict, end: dict) -> list[Keys]:
        return self.split(start["key"], end["key"])

    def commit(self, end: dict) -> None:
        pass


class KeyedPages(DataSource):
    """Options: ``url``; ``after`` and ``end`` for the keys ``(after, end]``; ``key`` (the first column), ``page_rows`` (100), ``ranges`` read
    at once (8), ``retries``, ``retry_s``, ``timeout_s``, ``token``."""

    @classmethod
    def name(cls) -> str:
        return "keyed_pages"

    def schema(self) -> str:
        return RAW

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(schema, self.options)


@dataclass
class Written(WriterCommitMessage):
    part: str
    points: int
    batches: int
    bytes: int


def _plain(value: object) -> object:
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    raise TypeError(f"{type(value).__name__} isn't JSON")


class _Writer(DataSourceWriter):
    """Points go to a place of the write's own, by the task's attempt; a commit names the attempts that count."""

    def __init__(self, options: dict):
        self.options, self.retry, self.write_id = dict(options), _retry(options), uuid.uuid4().hex
        self.most_bytes, self.most_points = int(options.get("most_bytes", 8 << 20)), int(options.get("most_points", 25))

    def _send(self, where: str, body: object = None, method: str = "POST"):
        return self.retry.run(lambda: request(f"{self.options['url']}/{where}", body, method, self.options.get("token"), float(self.options.get("timeout_s", 90))))

    def write(self, iterator: Iterator[Row]) -> Written:
        context = TaskContext.get()
        told, held, used = Written(f"{context.partitionId()}-{context.attemptNumber()}-{uuid.uuid4().hex[:8]}", 0, 0, 0), [], 0

        def send() -> None:
            nonlocal held, used
            if held:
                self._send(f"staged/{self.write_id}/{told.part}", {"batch": told.batches, "points": held})
                told.points, told.batches, told.bytes = told.points + len(held), told.batches + 1, told.bytes + used
                held, used = [], 0

        for row in iterator:
            point = row.asDict(recursive=True)
            size = len(json.dumps(point, ensure_ascii=False, default=_plain).encode())
            if used + size > self.most_bytes or len(held) >= self.most_points:
                send()
            held.append(json.loads(json.dumps(point, default=_plain)))
            used += size
        send()
        return told

    def commit(self, messages: list) -> None:
        self._send(f"commit/{self.write_id}", {"parts": [m.part for m in messages if m]})

    def abort(self, messages: list) -> None:
        self._send(f"staged/{self.write_id}", method="DELETE")


class PointBatches(DataSource):
    """Options: ``url``, ``most_bytes`` of a batch's points as JSON (8 MiB) and ``most_points`` (25); a point over the bytes goes alone."""

    @classmethod
    def name(cls) -> str:
        return "point_batches"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options)
