import math

import pytest
from pyspark.sql import functions as F

from docloom.config import Config
from docloom.operators import backfill, embed, points, search
from docloom.operators.store import Collection, merge_rows
from docloom.plans import jobs
from docloom.sources import scans
from docloom.streaming.loads import Progress, load

HTML = '<p class="judgtitle">Case {0}</p><p class="judgpara">[1] alpha beta word{0}</p><p class="judgpara">gamma</p>'


def raw(spark, n):
    return spark.createDataFrame([(100000 + i, "t", HTML.format(i), 0) for i in range(1, n + 1)], "file_name long, ftype string, html string, flag int")


def test_scans(spark):
    df = spark.range(10).select("id", F.when(F.col("id") != 4, "x").alias("t"))
    assert [r.id for r in scans.keyset_page(df, "id", 2, 3, "t").collect()] == [3, 5, 6]
    assert sorted(r.id for r in scans.keyset_range(df, "id", 2, 5).collect()) == [3, 4, 5]
    assert [r.id for r in scans.scroll(df, "id", 8, 5, ["t"]).collect()] == [8, 9]
    assert scans.first_row(df, "id").first().id == 0 and scans.ahead(df, "id", 7).count() == 2
    with pytest.raises(ValueError):
        scans.keyset_range(df, "id", 5, 5)


def test_merge_takes_the_last(spark):
    new = spark.createDataFrame([(1, 1), (1, 2)], "id long, v int")
    assert [tuple(r) for r in merge_rows(None, new, "id", F.col("v")).collect()] == [(1, 2)]


def test_upsert_takes_the_last_row_read(spark, tmp_path):
    c = Collection(spark, str(tmp_path / "c"))
    c.upsert(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, v string").coalesce(1))
    assert sorted(map(tuple, c.read().collect())) == [(1, "b"), (2, "c")]
    c.upsert(spark.createDataFrame([(1, "x", 2), (1, "y", 1)], "id long, v string, at int"), F.col("at"))
    assert {r.id: (r.v, r["at"]) for r in c.read().collect()} == {1: ("x", 2), 2: ("c", None)}
    assert not list((tmp_path / "c" / "staged").glob("*"))


def test_load_computes_vectors_once(spark, tmp_path, capsys):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        f = embed.hashing_embedder(8)

        def g(texts):
            calls.add(len(texts))
            return f(texts)

        return g

    loaded = load(raw(spark, 3), lambda chunks: embed.embed(chunks, "text", counting, 8))
    loaded.explain("formatted")
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Exchange" not in plan
    c = Collection(spark, str(tmp_path / "l"))
    c.upsert(loaded)
    c.upsert(loaded)
    assert calls.value == 6 and c.read().count() == 3
    assert {(r.case_id, r.title, len(r.dense)) for r in c.read().collect()} == {(100000 + i, f"Case {i}", 8) for i in (1, 2, 3)}


def test_batches(spark):
    df = spark.createDataFrame([(1, i, "x" * n) for i, n in enumerate([10, 10, 500, 10, 10])], "case_id long, o int, t string")
    found = points.batches(df, "case_id", "o", 200, 2).orderBy("o").collect()
    assert [r.batch for r in found] == [0, 0, 1, 2, 2]


def test_embedding_retries_and_long_texts(spark):
    def make():
        calls = []

        def f(texts):
            calls.append(len(texts))
            if len(calls) == 1:
                raise embed.Unavailable(503)
            if any(len(t) > 10 for t in texts):
                raise embed.TooLong("too long")
            return [[float(len(t)), 1.0] for t in texts]

        return f

    df = spark.createDataFrame([(1, "a"), (2, "a" * 20), (3, None)], "id int, t string").coalesce(1)
    rows = {r.id: (r.vector, r.skip_reason) for r in embed.embed(df, "t", make, 2, retry=embed.Retry(base_s=0, busy_s=0, jitter_s=0)).collect()}
    assert rows == {1: ([1.0, 1.0], None), 2: (None, "too long"), 3: ([0.0, 1.0], None)}
    assert embed.Retry(jitter_s=0).delay(9, None) == 60 and embed.Retry(jitter_s=0).delay(1, 429) == 5


def test_ranking(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "a b"), (2, [0.0, 0.0], "b"), (3, [1.0, 1.0], "a a c"), (4, None, None)], "id long, dense array<double>, sparse_text string")
    assert [(r.id, r.score) for r in search.dense_topk(df, [1.0, 0.0]).collect()] == [(1, 1.0), (3, round(math.sqrt(0.5), 6))]
    lexical = search.bm25_topk(df, "A z")
    assert [r.id for r in lexical.collect()] == [3, 1]
    fused = search.rrf([lexical, search.dense_topk(df, [1.0, 0.0])])
    assert [(r.id, r.score) for r in fused.collect()] == [(1, round(1 / 61 + 1 / 62, 6)), (3, round(1 / 61 + 1 / 62, 6))]
    assert search.postings(df).where("term = 'a'").orderBy("id").select("tf", "dl").collect() == [(1, 2), (2, 3)]
    for words in ([], [" "]):
        with pytest.raises(ValueError):
            search.query_text(words)


def test_backfills(spark):
    df = spark.createDataFrame([(1, "200001", None, "2"), (2, "200001", None, None), (3, None, "300001", "9"), (4, "x", "300001", "9")], "id long, file_name string, case_id string, court_id string")
    found = backfill.court_ids(df)
    assert backfill.summary(found).first().asDict() == {"scanned": 4, "updated": 2, "already_correct": 1, "missing_or_invalid": 1}
    assert [r.court_id for r in backfill.applied(found).orderBy("id").collect()] == [2, 2, 3, 9]
    dates = spark.createDataFrame([(1, "1 March 2000", "2000-03-01", "2000"), (2, "1 March 2000", None, None), (3, "?", None, None)], "id long, date_of_decision string, decision_date string, decision_year string")
    assert [r[0] for r in backfill.decision_dates(dates).orderBy("id").select("class").collect()] == ["already_correct", "updated", "missing_or_invalid"]


def test_jobs_end_to_end(spark, tmp_path):
    c = jobs.create_collection(spark, str(tmp_path / "p"))
    jobs.ingest(raw(spark, 5), c, 100000, 100004)
    assert c.read().count() == 4
    assert jobs.search(c, ["word3"], k=1).first().case_id == 100003
    assert jobs.hybrid(c, ["word2"]).first().case_id == 100002
    assert jobs.backfill_court_ids(c).first().updated == 4 and c.read().where("court_id = 1").count() == 4
    assert jobs.backfill_decision_dates(c).first().missing_or_invalid == 4
    shown = jobs.preview(raw(spark, 2))
    assert shown["case"].first().title == "Case 1" and shown["chunks"].count() == 1


def test_progress(tmp_path):
    path = str(tmp_path / "p.json")
    assert Progress.read(path) is None
    p = Progress("w", 0, 10, 5, 1, 2)
    p.save(path)
    assert Progress.read(path) == p and p.valid_for("w", 0, 10) and not p.valid_for("v", 0, 10) and not Progress("w", 0, 10, 10).valid_for("w", 0, 10)
    (tmp_path / "p.json").write_text("{")
    assert Progress.read(path) is None


def test_config():
    assert Config.read({"DOCLOOM_CHUNK_WORDS": "900"}).chunk_words == 900
    with pytest.raises(ValueError):
        Config().required("jdbc_url")
