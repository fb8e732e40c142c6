"""Web archives in ZIP packages: writing records with revisits, and reading them back by ranges, nothing extracted.

A package is a ZIP file of stored members: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdx`` (a line per record with its place). The reader takes a package's end and central directory
(ZIP64 too), finds the stored archives and indexes, splits long indexes, and reads records by their ranges. Tasks
reach the packages by pyarrow's file systems, so the folder has to be one that all executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm import scratch

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: A package is closed behind so many bytes or records; an index is read in such pieces, adjacent records by such reads.
PACKAGE_BYTES, PACKAGE_RECORDS, INDEX_BYTES, READ_BYTES, GAP_BYTES = 256 << 20, 50_000, 1 << 20, 4 << 20, 16 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


# ---- records


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(key: str | None, copy: int) -> str:
    return f"<urn:docloom:{'' if key is None else 'k' + quote(key, safe='')}:{copy}>"


def _key(name: str | None) -> str | None:
    found = name.strip("<>").split(":")[2] if name else ""
    return unquote(found[1:]) if found else None


def record(key: str | None, copy: int, url: str | None, sha1: str, size: int, payload: bytes | None, of: tuple[str | None, int] | None) -> bytes:
    """One record as bytes. ``of``: the key and copy of the record that a revisit repeats; its payload isn't stored."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if of else http + payload
    head = [("WARC-Type", "revisit" if of else "response"), ("WARC-Record-ID", _name(key, copy)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if " " < c != "\x7f" else quote(c) for c in url)))
    if of:
        head += [("WARC-Refers-To", _name(*of)), ("WARC-Profile", PROFILE)]
    head += [("WARC-Payload-Digest", f"sha1:{sha1}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head), "\r\n"]).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(raw: bytes) -> dict | None:
    """A response or revisit: its key, url, digest, size, payload. Other records (of requests, say) are None; one that doesn't
    hold what its fields say is an error."""
    head, end, rest = raw.partition(b"\r\n\r\n")
    if not end or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    found = _fields(head)
    block = rest[: int(found["content-length"])]
    if len(block) != int(found["content-length"]):
        raise ValueError(f"a record is cut: {found.get('warc-record-id')}")
    if (kind := found.get("warc-type")) not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    told = found.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and told and told != digest(payload):
        raise ValueError(f"a payload differs from its digest: {found.get('warc-record-id')}")
    size = len(payload) if kind == "response" else int(_fields(http).get("content-length", 0))
    return {
        "record": _key(found.get("warc-record-id")), "url": found.get("warc-target-uri"), "record_type": kind, "refers_to": _key(found.get("warc-refers-to")),
        "payload_bytes": size, "payload_digest": told or digest(payload), "payload": payload if kind == "response" else None,
    }


# ---- writing


class _Package:
    """One ZIP file while it is written: members are stored as they come, the index at the end."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"  # of a task's attempt alone; one that fails leaves a file that no row names
        system, where = pafs.FileSystem.from_uri(self.path)
        system.create_dir(where.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(where)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.data, self.size, self.lines = self.zip.open(DATA, "w", force_zip64=True), 0, []

    def add(self, raw: bytes, url: str | None, sha1: str) -> None:
        packed = gzip.compress(raw, 6, mtime=0)
        self.data.write(packed)
        told = {"url": url, "digest": f"sha1:{sha1}", "offset": self.size, "length": len(packed), "filename": DATA.rpartition("/")[2]}
        self.lines.append(f"{quote(url or '-', safe=':/?&=.')} {DATE} {json.dumps(told)}\n")
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for line in sorted(self.lines):
                index.write(line.encode())
        self.zip.close()
        self.file.close()
        return self.path, len(self.lines)


def _write(folder: str, most_bytes: int, most_records: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for key, copy, url, sha1, size, payload, of_key, of_copy in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package and (package.size >= most_bytes or len(package.lines) >= most_records):
                    done.append(package.close())
                    package = None
                package = package or _Package(folder)
                sha1 = base64.b32encode(bytes.fromhex(sha1)).decode()
                package.add(record(key, copy, url, sha1, size, payload, None if of_copy is None else (of_key, of_copy)), url, sha1)
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["package", "records"])

    return run


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", text: str = "html", least_bytes: int = 0, most_bytes: int = PACKAGE_BYTES, most_records: int = PACKAGE_RECORDS) -> DataFrame:
    """Packages of a record per row of ``pages`` in ``folder``; returns ``package, records``, the packages that count.

    Of rows with equal payloads (UTF-8; null is empty) of ``least_bytes`` at least, that with the largest key is the response
    (null keys are least; of equal keys the smallest url), the others revisit it; smaller payloads are all stored. Rows
    repeated exactly are records of their own. Payloads may be of any length that a row may have; of equal ones one
    is shuffled per task, revisits need none. An empty table gives no package; other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"), body.alias("payload"))
    rows = rows.withColumns({"name": F.unhex(F.sha2("payload", 256)), "sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    told = lambda copy, payload, of_key, of_copy: [F.col("k").cast("string").alias("key"), copy.cast("int").alias("copy"), F.col("u").alias("url"), "sha1", "size", payload.alias("payload"), of_key.cast("string").alias("of_key"), of_copy.cast("int").alias("of_copy")]
    none = F.lit(None)
    large = rows.where(F.col("size") >= least_bytes)
    small = rows.where(F.col("size") < least_bytes).select(*told(F.monotonically_increasing_id() % (1 << 30), F.col("payload"), none, none))
    with scratch.scope() as leave:
        slim = scratch.keep(large.groupBy("name", "k", "u", "sha1", "size").agg(F.count("*").alias("times")))
        rank = F.struct(F.col("k").isNotNull(), F.col("k"))
        top = slim.groupBy("name").agg(F.max(rank).alias("top"))
        best = scratch.keep(slim.join(top, "name").where(rank == F.col("top")).groupBy("name", "sha1", "size").agg(F.max("k").alias("k"), F.min(F.struct(F.col("u").isNotNull(), F.col("u"))).alias("u")).withColumn("u", F.col("u.u")))
        # copies of a key: numbered within a row's repetitions and, over rows that differ in their url alone, by url
        numbered = slim.withColumn("before", F.coalesce(F.sum("times").over(Window.partitionBy("name", "k").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        single = numbered.select("name", "k", "u", "sha1", "size", F.explode(F.sequence("before", F.col("before") + F.col("times") - 1)).alias("copy"))
        kept = best.select("name", F.col("k").alias("best"))
        revisits = single.join(kept, "name").where(~(F.col("k").eqNullSafe(F.col("best")) & (F.col("copy") == 0))).select(*told(F.col("copy"), none.cast("binary"), F.col("best"), F.lit(0)))
        payloads = large.groupBy("name").agg(F.first("payload").alias("payload"))
        responses = best.join(payloads, "name").select(*told(F.lit(0), F.col("payload"), none, none))
        records = responses.union(revisits).union(small)
        return leave(scratch.keep(records.mapInArrow(_write(folder, most_bytes, most_records), "package string, records long")))


# ---- reading


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    header: int
    length: int


def directory(read: Callable[[int, int], bytes], size: int) -> Iterator[Member]:
    """Members of a ZIP file from its central directory. ``read(at, length)`` reads a range; the directory is read in pieces."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) < at + 22 or at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    entries, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    end = tail_at + at
    locator = read(end - 20, 20) if end >= 20 else b""
    if locator.startswith(b"PK\x06\x07"):
        wide_at = int.from_bytes(locator[8:16], "little")
        wide = read(wide_at, 56)
        if not wide.startswith(b"PK\x06\x06"):
            raise ValueError("no end of a ZIP64 directory")
        entries, length, start = struct.unpack("<QQQ", wide[32:56])
        end = wide_at
    shift = end - length - start  # bytes in front of the first member
    held, here, at = b"", 0, start + shift  # ``here``: the next entry in what is held
    stop = at + length
    for _ in range(entries):
        if len(held) - here < 1 << 18 and at < stop:
            more = read(at, min(1 << 20, stop - at))
            held, here, at = held[here:] + more, 0, at + len(more)
        if held[here : here + 4] != b"PK\x01\x02":
            raise ValueError("a broken ZIP directory")
        flags, method = struct.unpack_from("<HH", held, here + 8)
        packed, plain, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", held, here + 20)
        (header,) = struct.unpack_from("<I", held, here + 42)
        here += 46
        name, extra = held[here : here + name_n], held[here + name_n : here + name_n + extra_n]
        here += name_n + extra_n + comment_n
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # of the sizes and the place, those that don't fit 32 bits
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        if flags & 1:
            raise ValueError("an encrypted member")
        yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, header + shift, packed)


def data_at(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where a member's bytes begin: behind its local header."""
    head = read(member.header, 30)
    if not head.startswith(b"PK\x03\x04"):
        raise ValueError("no member where the directory says")
    return member.header + 30 + sum(struct.unpack("<HH", head[26:30]))


def _opened(path: str):
    system, where = pafs.FileSystem.from_uri(path)
    file = system.open_input_file(where)
    return file, lambda at, length: file.read_at(length, at)


ARCHIVES = "package string, archives array<struct<name string, start long, length long>>, indexes array<struct<start long, length long>>"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    named = pa.struct([("name", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
    for batch in batches:
        for path in batch.column(0).to_pylist():
            file, read = _opened(path)
            with file:
                archives, indexes = [], []
                for m in directory(read, file.size()):
                    is_archive, is_index = m.name.endswith((".warc.gz", ".warc")), m.name.endswith((".cdx", ".cdxj"))
                    if (is_archive or is_index) and m.method != 0:
                        raise ValueError(f"{m.name} isn't stored, so its records can't be read by range")
                    if is_archive:
                        archives.append({"name": m.name.rpartition("/")[2], "start": data_at(read, m), "length": m.length})
                    elif is_index:
                        indexes.append({"start": data_at(read, m), "length": m.length})
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([archives], pa.list_(named)), pa.array([indexes], pa.list_(place))], ["package", "archives", "indexes"])


def _lines(read: Callable[[int, int], bytes], start: int, length: int, at: int, piece: int) -> Iterator[bytes]:
    """Lines of an index that begin in its bytes ``at`` to ``at + piece``."""
    here = max(at - 1, 0)  # the byte before tells whether a line begins at ``at``
    held, skip = b"", at > 0  # the line that goes on from the piece before belongs to that
    while here - len(held) < min(at + piece, length):
        more = read(start + here, min(1 << 18, length - here))
        here += len(more)
        *lines, rest = (held + more).split(b"\n")
        at_line = here - len(held) - len(more)
        held = rest
        for line in lines if more else [rest]:
            if not skip and at_line >= at + piece:
                return
            if line and not skip:
                yield line
            skip, at_line = False, at_line + len(line) + 1
        if not more:
            return


def _places(piece: int):
    """Pieces of indexes, or whole archives without one, as places of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, archives, start, length, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file, read = _opened(path)
                with file:
                    by, out = {a["name"]: a for a in archives}, []
                    found = (json.loads(line[line.index(b"{") :]) for line in _lines(read, start, length, at, piece)) if start is not None else (p for a in archives for p in _scanned(read, a))
                    for x in found:
                        out.append((path, by[x["filename"]]["start"] + int(x["offset"]), int(x["length"])))
                        if len(out) >= 10_000:
                            yield _placed(out)
                            out = []
                    if out:
                        yield _placed(out)

    return run


def _placed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.string(), pa.int64(), pa.int64()], strict=True)], ["package", "start", "length"])


def _scanned(read: Callable[[int, int], bytes], archive: dict) -> Iterator[dict]:
    """Places of an archive's records, one after the other (gzip members, or plain); what is held is one read."""
    if archive["name"].endswith(".warc"):
        at = 0
        while at < archive["length"]:
            head = read(archive["start"] + at, min(1 << 16, archive["length"] - at)).partition(b"\r\n\r\n")[0]
            used = len(head) + 4 + int(_fields(head)["content-length"]) + 4
            yield {"filename": archive["name"], "offset": at, "length": used}
            at += used
        return
    at, held, here = 0, b"", 0
    while at < archive["length"]:
        stream, used = zlib.decompressobj(31), 0
        while not stream.eof:
            if not held:
                held = read(archive["start"] + here, min(1 << 20, archive["length"] - here))
                here += len(held)
                if not held:
                    raise ValueError("an archive ends within a record")
            stream.decompress(held, 1 << 20)
            rest = stream.unused_data if stream.eof else stream.unconsumed_tail
            used, held = used + len(held) - len(rest), rest
        yield {"filename": archive["name"], "offset": at, "length": used}
        at += used


RECORDS = "package string, record string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted places as parsed records; those that lie side by side are read together."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
    path, file, read = None, None, None

    def parsed(run: list[tuple[int, int]]) -> Iterator[dict]:
        first, end = run[0][0], run[-1][0] + run[-1][1]
        raw = read(first, end - first)
        for start, length in run:
            one = raw[start - first : start - first + length]
            found = parse(gzip.decompress(one) if one.startswith(b"\x1f\x8b") else one)
            if found:
                yield {"package": path} | found

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

    run: list[tuple[int, int]] = []
    for batch in batches:
        for now, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run and (now != path or start > run[-1][0] + run[-1][1] + GAP_BYTES or start + length - run[0][0] > READ_BYTES):
                yield batch_of(list(parsed(run)))
                run = []
            if now != path:
                if file:
                    file.close()
                path, (file, read) = now, _opened(now)
            run.append((start, length))
    if run:
        yield batch_of(list(parsed(run)))
    if file:
        file.close()


def read(packages: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Records of ZIP packages (column ``package``, their paths): ``package, record, url, record_type, refers_to, payload_bytes,
    payload_digest, payload`` (null for a revisit, whose size stands in its HTTP header).

    Places of records come from the packages' indexes, for a package without one from a pass over its archives. They are
    dealt out by package and place, so a package may hold any share of all records. A package without records, or no
    package, gives no rows; a member that isn't stored, a broken directory or a payload unlike its digest is an error.
    """
    members = packages.select("package").repartition("package").mapInArrow(_members, ARCHIVES)
    pieces = F.transform("indexes", lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), F.sequence(F.lit(0), F.greatest(x["length"] - 1, F.lit(0)), F.lit(index_bytes)).alias("at")))
    either = F.when(F.size("indexes") > 0, pieces).otherwise(F.array(F.struct(F.lit(None).cast("long").alias("start"), F.lit(0).cast("long").alias("length"), F.array(F.lit(0).cast("long")).alias("at"))))
    split = members.select("package", "archives", F.explode(either).alias("x")).select("package", "archives", "x.start", "x.length", F.explode("x.at").alias("at"))
    places = split.repartition("package", "start", "at").mapInArrow(_places(index_bytes), "package string, start long, length long")
    dealt = places.distinct().repartitionByRange("package", "start").sortWithinPartitions("package", "start")
    return dealt.mapInArrow(_records, RECORDS)
