"""Collections: changes that touch only their partitions, interrupted changes, stored postings, payload and vector indexes, loads."""

import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import postings, search
from docloom.operators.store import MOST_SMALL, Collection
from docloom.operators.vector_index import VectorIndex, vector_topk
from docloom.plans import jobs
from docloom.streaming import loads

HTML = '<p class="judgtitle">Case {0}</p><p class="judgpara">[1] alpha beta word{0}</p><p class="judgpara">gamma</p>'


def raw(spark, first, last):
    return spark.createDataFrame([(100000 + i, "t", HTML.format(i), 0) for i in range(first, last + 1)], "file_name long, ftype string, html string, flag int")


def rows(spark, *x):
    return spark.createDataFrame(x, "id long, v string")


def files(path):
    """Data files of the rows with their times."""
    return {p: p.stat().st_mtime_ns for p in (path / "rows").rglob("*.parquet")}


def stored(c):
    return sorted(tuple(r) for r in c.read().collect())


@pytest.mark.parametrize("layout", [{"width": 10}, {"buckets": 4}])
def test_changes(spark, tmp_path, layout):
    c = Collection(spark, str(tmp_path / "c"), **layout)
    with pytest.raises(FileNotFoundError):
        c.read()
    assert c.ensure(rows(spark, (0, "")).schema) and not c.ensure(rows(spark, (0, "")).schema) and c.read().count() == 0
    c.upsert(rows(spark, (1, "a"), (2, "b"), (-5, "n")))
    c.upsert(rows(spark, (2, "c"), (33, "d")))
    c.upsert(rows(spark, (2, "c"), (33, "d")))
    assert stored(c) == [(-5, "n"), (1, "a"), (2, "c"), (33, "d")]
    assert sorted(r.id for r in c.between(-5, 2).collect()) == [-5, 1, 2] and [r.v for r in c.of_keys([33, 34]).collect()] == ["d"] and c.of_keys([]).count() == 0
    c.set_payload(spark.createDataFrame([(1, 7), (99, 9)], "id long, extra int"))
    assert {r.id: r.extra for r in c.read().collect()} == {-5: None, 1: 7, 2: None, 33: None}
    c.delete("id = 33 OR v = 'n'")
    again = Collection(spark, str(tmp_path / "c"))  # settings come from the folder
    assert stored(again) == [(1, "a", 7), (2, "c", None)] and again.settings == c.settings
    again.upsert(spark.createDataFrame([], "id long, v string"))
    assert stored(again) == stored(c)
    if "width" in layout:
        with pytest.raises(ValueError):
            again.upsert(spark.createDataFrame([(None, "x")], "id long, v string"))


def test_untouched_files_stay(spark, tmp_path):
    c = Collection(spark, str(tmp_path), width=100)
    c.upsert(spark.range(1000).select("id", F.lit("old").alias("v")))
    before = files(tmp_path)
    c.upsert(rows(spark, (150, "new"), (1001, "new")))
    after = files(tmp_path)
    assert {p for p in before if "part=1/" not in str(p)} == {p for p in after if "part=1/" not in str(p) and "part=10/" not in str(p)}
    assert all(after[p] == t for p, t in before.items() if p in after) and c.read().count() == 1001
    c.set_payload(rows(spark, (950, "set")))
    assert {p for p in files(tmp_path) if "part=9/" not in str(p)} == {p for p in after if "part=9/" not in str(p)}
    c.delete("id >= 300 AND id < 400")
    assert not list(tmp_path.glob("rows/*part=3")) and c.read().count() == 901


def test_cases_are_replaced(spark, tmp_path):
    c = Collection(spark, str(tmp_path), width=10)
    make = lambda *x: spark.createDataFrame(x, "id long, case_id int, v string")
    c.upsert(make((1, 1, "a"), (2, 1, "b"), (55, 1, "far"), (3, 2, "c")))
    c.upsert(make((1, 1, "A"), (3, 1, "moved")), replace="case_id")
    assert stored(c) == [(1, 1, "A"), (3, 1, "moved")]


def test_interrupted_changes(spark, tmp_path, monkeypatch):
    """Whatever step a writer stops at, the next one finds the change whole or not at all, once."""
    texts = lambda *x: spark.createDataFrame(x, "id long, t string")
    c = Collection(spark, str(tmp_path), width=10, text="t")
    c.upsert(texts((1, "one two"), (20, "two")), batch="a")
    for k, (step, whole) in enumerate([("_overwrite", True), ("files.rename", True), ("files.write:ledger", True), ("files.write:plan", False)]):
        broken = Collection(spark, str(tmp_path))
        target, _, only = step.partition(":")
        owner = broken.files if target.startswith("files.") else broken
        name = target.removeprefix("files.")
        plain = getattr(owner, name)

        def fail(*a, plain=plain, only=only):
            if only and only not in a[0]:
                return plain(*a)
            raise RuntimeError("lost")

        monkeypatch.setattr(owner, name, fail)
        new = texts((1, f"three k{k}"), (30 + k, "three"))
        with pytest.raises(RuntimeError):
            broken.upsert(new, batch=f"b{k}")
        after = Collection(spark, str(tmp_path))
        assert after.recover() == ([f"b{k}"] if whole else [])
        assert after.upsert(new, batch=f"b{k}") is not whole  # a batch that counts already isn't written again
        assert not after.upsert(texts((1, "never")), batch=f"b{k}")
        assert {r.id: r.t for r in after.read().collect()} == {1: f"three k{k}", 20: "two"} | {30 + j: "three" for j in range(k + 1)}
        same_as_scan(after, [f"k{k} two three"])
    assert {x["batch"] for x in after.ledger()} == {"a", "b0", "b1", "b2", "b3"}


def test_new_rows_leave_stored_files(spark, tmp_path):
    """Rows of new keys become further files of their partition; only partitions of which a row goes, or of many small files, are written anew."""
    c = Collection(spark, str(tmp_path), width=100)
    c.upsert(rows(spark, (1, "a"), (2, "b")))
    first = files(tmp_path)
    c.upsert(rows(spark, (3, "c"), (3, "d"), (4, "e")))
    second = files(tmp_path)
    assert first.items() < second.items() and stored(c) == [(1, "a"), (2, "b"), (3, "d"), (4, "e")]
    c.upsert(rows(spark, (4, "f"), (5, "g")))
    assert not second.keys() & files(tmp_path).keys() and stored(c) == [(1, "a"), (2, "b"), (3, "d"), (4, "f"), (5, "g")]
    for k in range(6, 8 + MOST_SMALL):
        c.upsert(rows(spark, (k, "x")))
    assert len(files(tmp_path)) <= MOST_SMALL and c.read().count() == 7 + MOST_SMALL


def test_words_are_counted_where_their_texts_are(spark):
    """A change's texts are shuffled, not their words."""
    old = spark.createDataFrame([(1, "a a b"), (2, "a c")], "id long, t string")
    new = spark.createDataFrame([(1, "a b b b"), (3, None)], "id long, t string")
    found = postings.delta("id", "t", new, old, size=40 << 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    summed = found.groupBy("term", "id").agg(F.sum("tf"), F.sum("dl")).collect()
    assert sorted(map(tuple, summed), key=str) == sorted([("a", 1, -1, 1), ("b", 1, 2, 1), ("a", 2, -1, -2), ("c", 2, -1, -2), (None, None, 0, -1)], key=str)


def same_as_scan(c, queries):
    for q in queries:
        want = [tuple(r) for r in search.bm25_topk(c.read(), q, 50, c.key, c.text).collect()]
        assert [tuple(r) for r in postings.bm25_topk(c.postings(), q, 50).collect()] == want, q


def test_postings_follow_all_changes(spark, tmp_path):
    r = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "rare"]
    text = lambda: r.choice([None, "", *(" ".join(r.choices(words, [9, 5, 3, 2, 1], k=r.randint(1, 20))) for _ in range(9))])
    c, queries = Collection(spark, str(tmp_path), buckets=3, text="t"), ["alpha rare", "Beta, gamma missing"]
    batch = lambda n: spark.createDataFrame([(r.randrange(60), text(), k) for k in range(n)], "id long, t string, at int")
    for _ in range(3):
        c.upsert(batch(30), F.col("at"))
        same_as_scan(c, queries)
    c.delete("id % 4 = 0")
    same_as_scan(c, queries)
    c.set_payload(spark.createDataFrame([(1, "alpha rare"), (2, None), (3, "")], "id long, t string"))
    same_as_scan(c, queries)
    n = c.postings().count()
    c.compact()
    same_as_scan(c, queries)
    assert c.postings().count() < n and len(c.files.names("postings")) == 1
    c.upsert(batch(20), F.col("at"))
    same_as_scan(c, queries)
    with pytest.raises(ValueError):
        postings.bm25_topk(c.postings(), " ,")


def test_a_query_reads_its_terms_buckets(spark, tmp_path):
    c = Collection(spark, str(tmp_path), width=10, text="t")
    c.upsert(spark.range(200).select("id", F.concat(F.lit("every w"), F.col("id")).alias("t")))
    plan = postings.bm25_topk(c.postings(), "w7 w8")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    found = c.postings().where(F.col("bucket").isin([r[0] for r in spark.createDataFrame([("w7",), ("w8",)], "t string").select(postings.bucket("t")).collect()]))
    assert len(found.inputFiles()) > 2 and metric(found, "numFiles") <= 2


def metric(df, name):
    """A metric of the scan in a plan that has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply(name).value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains(name))


def test_payload_index(spark, tmp_path):
    c = Collection(spark, str(tmp_path), width=100)
    c.upsert(spark.range(1000).select("id", (F.col("id") / 50).cast("int").alias("year"), F.lit("x").alias("v")))
    plain, want = metric(c.where("year", 7), "numFiles"), [tuple(x) for x in c.where("year", 7).orderBy("id").collect()]
    assert c.create_index("year") and not c.create_index("year")
    found = c.where("year", 7)
    assert metric(found, "numFiles") == 1 < plain and [tuple(x) for x in found.orderBy("id").collect()] == want
    assert metric(c.where("year", 2, 5), "numFiles") == 2 and c.where("year", 2, 5).count() == 200 and c.where("year", 99).count() == 0
    c.set_payload(spark.createDataFrame([(905, 7)], "id long, year int"))
    assert sorted(r.id for r in c.where("year", 7).collect()) == [*range(350, 400), 905] and metric(c.where("year", 7), "numFiles") == 2
    c.delete("id = 905")
    assert metric(c.where("year", 7), "numFiles") == 1
    assert Collection(spark, str(tmp_path)).where("year", 19).count() == 50


def recall(c, index, queries, k=10):
    exact = [{r.id for r in search.dense_topk(c.read("id", "dense"), q, k).collect()} for q in queries]
    return float(np.mean([len({r.id for r in index.topk(q, k).collect()} & e) / k for q, e in zip(queries, exact, strict=True)]))


def test_vector_index_on_the_given_table(spark, tmp_path):
    c = Collection(spark, str(tmp_path), width=500)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    c.upsert(table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense")))
    assert VectorIndex.build(c) is None  # fewer rows than are worth it: search stays exact
    query = [float(x) for x in table.where("vec_id = 3").first().embedding]
    assert vector_topk(c, query, 3).collect() == search.dense_topk(c.read(), query, 3).collect()
    index = VectorIndex.build(c, least_rows=1000)
    assert index.settings["lists"] == 45 and 1 <= index.settings["probes"] < 45
    queries = [[float(x) for x in r.embedding] for r in table.where("vec_id % 200 = 7").collect()]
    assert recall(c, index, queries) >= 0.9
    plan = index.candidates(query, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan


def test_vector_index_follows_changes(spark, tmp_path):
    r = np.random.default_rng(2)
    centres = r.normal(size=(30, 16)) * 3
    points = centres[r.integers(0, 30, 3000)] + r.normal(size=(3000, 16))
    make = lambda first, vectors: spark.createDataFrame([(first + k, None if v is None else [float(x) for x in v]) for k, v in enumerate(vectors)], "id long, dense array<float>")
    c = Collection(spark, str(tmp_path), width=1000)
    c.upsert(make(0, points))
    c.upsert(make(5000, [None, [0.0] * 16, [float("nan")] * 16, [1.0]]))
    index = VectorIndex.build(c, least_rows=100)
    assert index.settings["probes"] <= 15 and recall(c, index, points[:8]) >= 0.9
    far = [9.0] + [0.0] * 15
    c.upsert(make(7000, [far]))  # a new row, and one whose vector moves away
    c.upsert(make(0, [[-x for x in points[0]]]))
    c.delete("id = 1")
    index = VectorIndex.of(c)
    assert index.topk(far, 1).first().id == 7000
    assert 0 not in {x.id for x in index.topk(points[0].tolist(), 20).collect()} and 1 not in {x.id for x in index.topk(points[1].tolist(), 20).collect()}
    assert index.topk((-points[0]).tolist(), 1).first().id == 0
    assert recall(c, VectorIndex.build(c, least_rows=100), points[:8]) >= 0.9


def test_hybrid_job_with_stored_indexes(spark, tmp_path):
    plain, stored_ = jobs.create_collection(spark, str(tmp_path / "p")), jobs.create_hybrid_collection(spark, str(tmp_path / "h"))
    for c in (plain, stored_):
        jobs.ingest(raw(spark, 1, 6), c, 100000, 100009)
    for words in (["word2"], ["gamma"], ["alpha", "word5"]):
        assert jobs.hybrid(stored_, words).collect() == jobs.hybrid(plain, words).collect()
    assert jobs.backfill_court_ids(stored_).first().updated == 6 and stored_.where("court_id", 1).count() == 6 and stored_.settings["indexes"] == ["court_id"]


def test_streamed_load_is_exactly_once(spark, tmp_path, monkeypatch):
    source, checkpoint = str(tmp_path / "source"), str(tmp_path / "checkpoint")
    c = jobs.create_hybrid_collection(spark, str(tmp_path / "c"))
    rates = loads.Rates()
    spark.streams.addListener(rates)
    for k in range(4):
        raw(spark, 10 * k + 1, 10 * k + 3).coalesce(1).write.mode("append").parquet(source)
    options = {"after": 100000, "end": 100099, "files_at_once": 1}
    stop, plain = threading.Event(), Collection.upsert

    def stopping(self, *a, **b):
        out = plain(self, *a, **b)
        if len(self.ledger()) == 2:
            stop.set()
        return out

    monkeypatch.setattr(Collection, "upsert", stopping)
    first = loads.run_load(spark, source, c, checkpoint, stop=stop, **options)
    assert (first["cases"], first["batches"]) == (6, 2)  # between batches, nothing half done
    monkeypatch.undo()

    def failing(self, *a, **b):  # the batch is written, but the stream dies before it counts as done there
        plain(self, *a, **b)
        raise RuntimeError("lost")

    monkeypatch.setattr(Collection, "upsert", failing)
    with pytest.raises(Exception, match="lost"):
        loads.run_load(spark, source, c, checkpoint, **options)
    monkeypatch.undo()
    assert len(c.ledger()) == 3
    last = loads.run_load(spark, source, c, checkpoint, **options)
    assert {k: last[k] for k in ("cases", "chunks", "batches")} == {"cases": 12, "chunks": 12, "batches": 4} and last["bytes"] > 1000
    assert last["cases_per_minute"] == last["cases"] / last["minutes"] > 0
    assert sorted(r.case_id for r in c.read().collect()) == [100000 + 10 * k + j for k in range(4) for j in (1, 2, 3)]
    again = loads.run_load(spark, source, c, checkpoint, **options)
    assert again["cases"] == 12
    spark.streams.removeListener(rates)
    assert sum(b["rows"] for b in rates.batches) >= 9 and all(b["rows_per_minute"] >= 0 for b in rates.batches)


def test_streamed_load_rewrites_what_it_touches(spark, tmp_path):
    """Cases of another hundred leave the files of the first as they are, so a long load isn't quadratic."""
    source, c = str(tmp_path / "source"), jobs.create_collection(spark, str(tmp_path / "c"))
    raw(spark, 1, 3).write.parquet(source)
    loads.run_load(spark, source, c, str(tmp_path / "k"))
    before = files(tmp_path / "c")
    raw(spark, 301, 303).write.mode("append").parquet(source)
    loads.run_load(spark, source, c, str(tmp_path / "k"))
    after = files(tmp_path / "c")
    assert before.items() <= after.items() and c.read().count() == 6
