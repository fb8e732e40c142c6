import os

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from docloom.llm import queries, scratch, toxicity

from . import helpers
from .test_pack_bpe import check_packing, ids_by_tokenizers
from .test_scans_filters import labelled

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_turn(spark, tmp_path):
    docs, labels = labelled(spark, 120)
    extra = [(1000, "shared line of five words\nwrite to a@b.example.com now"), (1001, "shared line of five words\nanother line with words here"), (1002, None), (1003, ""), (1004, "one two three four"), (1005, "ONE two three  four")]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "pii", "packing"]
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and 70 <= kept.count() <= 92
    texts = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, kept, str(tmp_path)).collect()}
    assert texts[1001] == "another line with words here" and texts[1002] is None
    assert {r.doc_id for r in kept.collect()} - texts.keys() == {1005}  # nothing of it stays
    near = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, kept, str(tmp_path)).collect()}
    assert 1004 in near and 1005 not in near and {1002, 1003} <= near
    masked = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.mask_personal_data(spark, kept, str(tmp_path)).collect()}
    assert masked[1000][0].endswith("write to <EMAIL> now") and masked[1000][1] == len(masked[1000][0]) and not any(helpers.base_spans(t) for t, _ in masked.values())
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    wanted = {r.doc_id for r in rows}
    assert {1000, 1001, 1002, 1003} <= wanted
    packed = corpus_pipeline.pack_sequences(spark, kept, str(tmp_path)).collect()
    check_packing(packed, {r.doc_id: ids_by_tokenizers(r.text or "") + [1] for r in kept.collect()}, 2048)


def test_toxicity_sends_few_rows_at_once(spark, tmp_path, monkeypatch):
    docs, labels = labelled(spark, 1500)
    docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars").union(spark.createDataFrame([(9000, None, "en", "s", None), (9001, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars int"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    wanted = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 0").collect()}
    sent = []
    keep = scratch.keep
    monkeypatch.setattr(scratch, "keep", lambda df, batch_rows=None: (sent.append(batch_rows), keep(df, batch_rows))[1])
    before = spark.conf.get(scratch.BATCH_ROWS)
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()}
    assert kept == wanted and {9000, 9001} <= kept and 0 < len(kept) < docs.count()
    assert 512 in sent and spark.conf.get(scratch.BATCH_ROWS) == before
    texts = docs.select("text").coalesce(1)
    sizes = keep(texts.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [len(b)]}) for b in batches), "n long"), batch_rows=512).collect()
    assert max(r.n for r in sizes) <= 512


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_give_what_their_sql_gives(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    wanted = connection.sql(queries.ORACLES[name])
    found = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(repr, wanted.select(*columns).fetchall()))
