"""Remote sources, sinks and embedding services, against services of this process that fail on purpose."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from docloom.config import Config
from docloom.operators import embed
from docloom.operators.store import Collection
from docloom.plans import jobs
from docloom.sources import http, remote, scans
from docloom.streaming import loads

DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"
HTML = '<p class="judgtitle">Case {0}</p><p class="judgpara">[1] alpha word{0}</p>'


class Service:
    """Rows by key, staged and committed points, and vectors; every third request fails once, in turn in another way."""

    def __init__(self):
        self.rows, self.asked, self.staged, self.points, self.commits, self.ended = {}, [], {}, [], 0, set()
        self.lock, self.failures, self.fail = threading.Lock(), 0, True
        service = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *_):
                pass

            def answer(self):
                body = self.rfile.read(int(self.headers.get("content-length") or 0))
                with service.lock:
                    service.asked.append((self.command, self.path, len(body), time.monotonic()))
                    if service.fail and len(service.asked) % 3 == 0:
                        service.failures += 1
                        code = [503, 429, 500, 408][service.failures % 4]
                    else:
                        code, out = service.do(self.command, urlparse(self.path), json.loads(body) if body else None)
                if code != 200:
                    out = {"error": out} if code == 400 else {}
                raw = json.dumps(out).encode()
                self.send_response(code)
                self.send_header("content-length", str(len(raw)))
                self.end_headers()
                self.wfile.write(raw)

            do_GET = do_POST = do_DELETE = answer

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def do(self, method, url, body):
        parts, query = url.path.strip("/").split("/"), {k: int(v[0]) for k, v in parse_qs(url.query).items()}
        if parts[0] == "rows":
            if "last" in query:
                return 200, {"key": max(self.rows, default=-1)}
            keys = sorted(k for k in self.rows if query["after"] < k <= query["end"])[: query["limit"]]
            return 200, [self.rows[k] for k in keys]
        if parts[0] == "vectors":
            if any(len(t) > 900 for t in body["input"]):
                return 400, "maximum context length is 900"
            return 200, {"data": [{"embedding": [float(len(t)), 1.0]} for t in body["input"]]}
        if method == "DELETE":
            self.staged.pop(parts[2], None)
            self.ended.add(parts[2])
        elif parts[0] == "points" and parts[1] == "staged" and parts[2] in self.ended:  # a task that still ran when its write was given up
            return 410, {}
        elif parts[1] == "none":
            return 200, {}
        elif parts[1] == "commit":
            own = self.staged.pop(parts[2], {})
            self.points += [b for p in body["parts"] for b in own.get(p, {}).values()]
            self.commits += 1
        else:  # a batch that is sent twice is one
            self.staged.setdefault(parts[2], {}).setdefault(parts[3], {})[body["batch"]] = body["points"]
        return 200, {}


@pytest.fixture
def service(spark):
    for source in (remote.KeyedPages, remote.PointBatches):
        spark.dataSource.register(source)
    found = Service()
    yield found
    found.server.shutdown()


def fill(service, first, last):
    service.rows |= {k: {"file_name": k, "ftype": None, "jtext": HTML.format(k), "flag": 1} for k in range(first, last + 1) if k % 7}


def pages(spark, service, stream=False, **options):
    reader = (spark.readStream if stream else spark.read).format("keyed_pages").option("url", f"{service.url}/rows").option("retry_s", 0.01).option("page_rows", 10)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def test_pages_are_read_once_with_failures(spark, service):
    fill(service, 100001, 100200)
    found = pages(spark, service, after=100010, end=100150, ranges=4)
    assert sorted(r.file_name for r in found.collect()) == [k for k in sorted(service.rows) if 100010 < k <= 100150]
    assert found.rdd.getNumPartitions() == 4 and service.failures > 3
    assert pages(spark, service, after=100190).count() == len([k for k in service.rows if k > 100190])
    assert all("limit=10" in path or "last=1" in path for _, path, *_ in service.asked)
    with pytest.raises(Exception, match="behind its start"):
        pages(spark, service, after=5, end=5).count()
    service.rows.clear()
    assert pages(spark, service).count() == 0


def test_a_source_that_stays_away_or_goes_back(spark, service):
    fill(service, 1, 30)
    service.rows[31] = {"file_name": 3, "jtext": ""}
    with pytest.raises(Exception, match="doesn't go forward"):
        pages(spark, service).collect()
    service.do = lambda *_: (503, {})
    with pytest.raises(Exception, match="status 5|status 4"):
        pages(spark, service, end=20, retries=2).collect()


def test_streamed_pages_go_on_behind_the_last_key(spark, service, tmp_path):
    c = jobs.create_collection(spark, str(tmp_path / "c"))
    options = {"spark": spark, "checkpoint": str(tmp_path / "k"), "source": "", "collection": c}
    for last in (100010, 100025):
        fill(service, 100001, last)
        rows = scans.raw_records(pages(spark, service, stream=True, after=100000, end=100020))
        totals = loads.run_load(rows=rows, **options)
    want = [k for k in sorted(service.rows) if k <= 100020]
    assert sorted(r.case_id for r in c.read().collect()) == want and totals["cases"] == len(want)


def write(spark, service, df, **options):
    writer = df.write.format("point_batches").mode("append").option("url", f"{service.url}/points").option("retry_s", 0.01)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save()


def test_write_batches_keep_both_limits(spark, service):
    size = lambda b: sum(len(json.dumps(p, ensure_ascii=False).encode()) for p in b)
    small = spark.range(0, 130, 1, 3).select("id", F.lit("é").alias("t"), F.array(F.lit(0.5)).alias("dense"), F.to_date(F.lit("2020-02-03")).alias("d"))
    write(spark, service, small)
    assert sorted(p["id"] for b in service.points for p in b) == list(range(130)) and max(map(len, service.points)) == 25 and service.points[0][0]["d"] == "2020-02-03"
    service.points.clear()
    large = spark.range(0, 30, 1, 2).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 7, 9 << 20).otherwise(1 << 20).cast("int")).alias("t"))
    write(spark, service, large)  # 8 MiB bind: seven points of 1 MiB and their keys
    assert sorted(p["id"] for b in service.points for p in b) == list(range(30)) and [[p["id"] for p in b] for b in service.points if size(b) > 8 << 20] == [[7]]
    assert max(len(b) for b in service.points) == 7 and service.commits == 2 and not service.staged
    write(spark, service, small.where("id < 0"))


def test_a_failed_write_leaves_nothing(spark, service):
    bad = spark.range(0, 200, 1, 4).select("id", F.when(F.col("id") == 199, F.raise_error(F.lit("broken row"))).otherwise("x").alias("t"))
    with pytest.raises(Exception, match="broken row"):
        write(spark, service, bad)
    assert service.points == [] and service.commits == 0 and not service.staged


def test_embedding_service(spark, service, tmp_path):
    texts = [(k, "a" * (1000 if k in (3, 40) else k + 1), 4 if k < 30 else 2) for k in range(60)]
    df = spark.createDataFrame(texts, "id int, t string, n int").coalesce(1)
    url, retry = f"{service.url}/vectors", embed.Retry(base_s=0.01, busy_s=0.01, jitter_s=0)
    found = embed.embed(df, "t", lambda: embed.http_embedder(url, "m"), 2, "n", retry, at_once=3, pause_s=0.01).collect()
    assert [r.id for r in found] == list(range(60)) and [r.id for r in found if r.skip_reason] == [3, 40]
    assert all(r.vector == [float(len(r.t)), 1.0] for r in found if not r.skip_reason) and service.failures > 5
    begun = sorted(x[3] for x in service.asked)
    assert min(b - a for a, b in zip(begun, begun[2:], strict=False)) > 0.005  # paced, whatever is under way
    wrong = f"{service.url}/points/none"
    with pytest.raises(Exception, match="KeyError"):
        embed.embed(df, "t", lambda: embed.http_embedder(wrong, "m"), 2, 16, retry).collect()


def test_requests_that_time_out(service):
    service.do = lambda *_: time.sleep(0.5) or (200, {})
    service.fail = False
    with pytest.raises(http.Unavailable) as e:
        http.request(service.url, timeout_s=0.1)
    assert e.value.status == 408
    with pytest.raises(http.Unavailable):
        http.request("http://127.0.0.1:9/", timeout_s=1)


def test_ingest_by_the_service(spark, service, tmp_path):
    fill(service, 100001, 100006)
    c = Collection(spark, str(tmp_path), width=1 << 30)
    url = f"{service.url}/vectors"
    jobs.ingest(scans.raw_records(pages(spark, service)), c, 100000, 100009, size=2, embedder=lambda: embed.http_embedder(url, "m"), retry=embed.Retry(base_s=0.01, busy_s=0.01, jitter_s=0))
    assert sorted(r.case_id for r in c.read().where("dense[1] = 1").collect()) == sorted(service.rows)


def test_configured_load_from_a_database(spark, service, tmp_path):
    """Ranges of a database table in parallel, with the passages' vectors from the service."""
    url = f"jdbc:derby:{tmp_path}/db"
    table = spark.createDataFrame([(100000 + k, "t", "" if k == 5 else HTML.format(k), 0) for k in range(1, 41)], remote.RAW)
    table.write.jdbc(f"{url};create=true", "cases", properties={"driver": DRIVER, "createTableColumnTypes": "jtext VARCHAR(2000)"})
    given = {"TABLE": "cases", "COLLECTION": str(tmp_path / "c"), "JDBC_URL": url, "JDBC_DRIVER": DRIVER, "PAGE_ROWS": "10", "VECTOR_SIZE": "2", "EMBEDDING_URL": f"{service.url}/vectors"}
    config, service.fail = Config.read({f"DOCLOOM_{k}": v for k, v in given.items()}), False
    assert jobs.source(spark, config, 100000, 100040).rdd.getNumPartitions() == 4
    c = jobs.load_range(spark, config, 100003, 100030)
    assert sorted(r.case_id for r in c.read().where("dense[1] = 1").collect()) == [100000 + k for k in range(4, 31) if k != 5]
    assert jobs.hybrid(c, ["word7"], 2).first().case_id == 100007
