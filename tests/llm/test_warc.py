import base64
import glob
import hashlib
import io
import os
import random
import zipfile

import pytest

from docloom.llm import warc as W
from docloom.llm.queries import op13_warc

SCHEMA = "page_id long, url string, html string"


def expected(rows, least=0):
    """(page_id, payload_bytes, digest, type, refers_to) of every row."""
    best, out = {}, []
    for page, _, html in rows:
        best[html or ""] = max(best.get(html or "", (False, 0)), (page is not None, page or 0))
    first = set()
    for page, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        top = best[html or ""]
        kept = len(raw) < least or ((page is not None, page or 0) == top and html not in first and not (html is None and "" in first))
        if kept:
            first.add(html or "")
        out.append((page, len(raw), digest, "response" if kept else "revisit", None if kept or not top[0] else top[1]))
    return sorted(out, key=repr)


def told(found):
    number = lambda x: None if x is None else int(x)
    return sorted(((number(r.record), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in found), key=repr)


def rows_of(seed, n):
    r = random.Random(seed)
    bodies = [None, "", "x", "é" * 40, "<html>" + "ab" * 900, *("p%d " % k * r.randint(1, 300) for k in range(n // 3))]
    return [(k, r.choice([None, f"http://a.example/{k}?q=ü b", "http://b.example/\r\nX: 1", "x" * 3000]), r.choice(bodies)) for k in range(n)]


def in_memory(raw):
    return lambda at, length: raw[at : at + length]


@pytest.mark.parametrize("most_bytes, most_records, index_bytes, least", [(W.PACKAGE_BYTES, W.PACKAGE_RECORDS, W.INDEX_BYTES, 0), (3000, 7, 100, 0), (50_000, 1000, 333, 20)])
def test_round_trip(spark, tmp_path, most_bytes, most_records, index_bytes, least):
    rows = rows_of(most_records, 150) + [(None, "u", "<html>" + "ab" * 900), (None, None, "only null"), (None, None, "only null"), (149, "u", "twice"), (149, "u", "twice"), (149, "v", "twice"), (3, "u", "twice")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", payload string, name int").repartition(6)
    packages = W.write(df, f"file://{tmp_path}/a", least_bytes=least, most_bytes=most_bytes, most_records=most_records)
    found = W.read(packages, index_bytes).collect()
    assert told(found) == expected(rows, least)
    assert sum(r.records for r in packages.collect()) == len(rows)
    texts = {html or "" for _, _, html in rows}
    assert {r.payload.decode() for r in found if r.record_type == "response"} == texts and all(r.payload is None for r in found if r.record_type == "revisit")
    if most_records == 7:
        assert all(r.records <= 7 for r in packages.collect())


def test_other_programs_read_the_packages(spark, tmp_path):
    rows = [(1, "http://a/", "one"), (2, "http://b/", "two"), (3, None, "one")]
    [package] = W.write(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path)).coalesce(1).collect()[:1]
    with zipfile.ZipFile(package.package) as z:
        assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED} and z.namelist() == [W.DATA, W.INDEX]


def packed(monkeypatch, wide, names=3, comment=b"", front=b""):
    out = io.BytesIO()
    if wide:  # limits so low that every size, place and count takes the ZIP64 form
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 3)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out.write(front)
    with zipfile.ZipFile(out, "a" if front else "w") as z:
        z.comment = comment
        for k in range(names):
            with z.open(zipfile.ZipInfo(f"archive/é{k}.warc.gz"), "w", force_zip64=wide) as m:
                m.write(b"content %d" % k)
    monkeypatch.undo()
    return out.getvalue()


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("comment, front", [(b"", b""), (b"PK\x05\x06 not the end", b""), (b"", b"#!prefix\n" * 9)])
def test_directories(monkeypatch, wide, comment, front):
    if wide and front:
        pytest.skip("the library can't append in this form")
    raw = packed(monkeypatch, wide, 3, comment, front)
    assert (b"PK\x06\x06" in raw) == wide
    read = in_memory(raw)
    found = list(W.directory(read, len(raw)))
    assert [m.name for m in found] == [f"archive/é{k}.warc.gz" for k in range(3)]
    assert [raw[(at := W.data_at(read, m)) : at + m.length] for m in found] == [b"content 0", b"content 1", b"content 2"]


def test_large_directory_and_broken_ones(monkeypatch):
    raw = packed(monkeypatch, False, 40_000)
    assert len([*W.directory(in_memory(raw), len(raw))]) == 40_000
    for broken in (b"", b"PK", raw[:-1], raw[:1000]):
        with pytest.raises(ValueError):
            list(W.directory(in_memory(broken), len(broken)))


def test_index_pieces_give_every_line_once():
    r = random.Random(5)
    for _ in range(60):
        lines = [bytes(r.choices(b"abc", k=r.randint(0, 30))) for _ in range(r.randint(0, 40))]
        raw = b"\n".join(lines) + b"\n" * r.randint(0, 1)
        piece = r.randint(1, 50)
        found = [x for at in range(0, max(len(raw), 1), piece) for x in W._lines(in_memory(b"##" + raw), 2, len(raw), at, piece)]
        assert found == [x for x in lines if x]


@pytest.mark.parametrize("name", ["data.warc.gz", "data.warc"])
def test_packages_without_an_index(spark, tmp_path, name):
    records = [W.record(str(k), 0, f"http://a/{k}", W.digest(b"p" * k * 9999), k * 9999, b"p" * k * 9999, None) for k in range(6)]
    records.insert(2, b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    import gzip

    with zipfile.ZipFile(tmp_path / "x.wacz", "w") as z:
        z.writestr(f"archive/{name}", b"".join(gzip.compress(x) if name.endswith("gz") else x for x in records))
    found = W.read(spark.createDataFrame([(str(tmp_path / "x.wacz"),)], "package string")).collect()
    assert sorted((int(r.record), r.payload_bytes) for r in found) == [(k, k * 9999) for k in range(6)]


def test_faults_are_errors(spark, tmp_path):
    good = W.record("1", 0, "u", W.digest(b"abc"), 3, b"abc", None)
    for bad in (good.replace(b"abc\r\n\r\n", b"abd\r\n\r\n"), good[:-6], b"HTTP/1.1 200"):
        with pytest.raises(ValueError):
            W.parse(bad)
    with zipfile.ZipFile(tmp_path / "x.wacz", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(W.DATA, good * 100)
    with pytest.raises(Exception, match="isn't stored"):
        W.read(spark.createDataFrame([(str(tmp_path / "x.wacz"),)], "package string")).collect()


def test_empty_table_and_long_payloads(spark, tmp_path):
    packages = W.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert packages.collect() == [] and W.read(packages).collect() == []
    rows = [(1, "u", "z" * 9_000_000), (2, "u", "z" * 9_000_000), (3, "u", "é" * 2_000_000)]
    assert told(W.read(W.write(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "long"))).collect()) == expected(rows)


def test_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    before = set(glob.glob(os.path.join(spark.conf.get("spark.checkpoint.dir"), "*", "*.wacz")))
    found = op13_warc(spark, folder)
    assert sorted(map(tuple, found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == expected(rows)
    assert set(glob.glob(os.path.join(spark.conf.get("spark.checkpoint.dir"), "*", "*.wacz"))) == before
