import hashlib
import random

from docloom.llm import pii, queries

from .helpers import base_spans

TEXTS = [
    "", None, "mail a.b+c@x.example.com, or a@b.c_d@e.f", "1.2.3.4.5.6.7.8 and 999.1.1.1 and 0010.2.3.004", "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (017) 555-7713 +49 30 1 +" + "1" * 40,
    "é" * 5 + "x@y.z", "1" * 5000, "a" * 5000 + "@", "1 2 " * 2000, "+1 () ((", "a@b@c.d @x.y", "12:30 1.2.3 -@-.-",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans_are_those_of_the_patterns(spark):
    rng = random.Random(2)
    pieces = ["@", ".", "a", "b-", "1", "22", "255", "+", " ", "(", ")", "4111111111111111", "x@y.z", "_", "%", "é", "\n", "0"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(600)]
    docs = frame(spark, texts)
    rows = pii.annotate(docs, pii.fit(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base, spans = ([(s.kind, s.start, s.stop) for s in x] for x in (r.base, r.spans))
        assert base == base_spans(r.text), r.text
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        added = set(spans) - set(base)
        assert all(s >= b[2] or e <= b[1] for _, s, e in added for b in base)


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{i}@h{i}.com 10.0.{i % 256}.1" for i in range(1500))
    docs = frame(spark, [text])
    row = pii.annotate(docs, pii.fit(docs)).first()
    assert [(s.kind, s.start, s.stop) for s in row.base] == base_spans(text)


def test_loose_forms_with_support_are_added(spark):
    rng = random.Random(4)
    number = lambda: f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    texts = [f"please call +1 {number()} today" for _ in range(200)] + [f"phone: {number()} please" for _ in range(60)] + [f"serial {rng.randint(10**9, 10**10)} in stock" for _ in range(200)]
    docs = frame(spark, texts)
    rows = pii.annotate(docs, pii.fit(docs)).orderBy("doc_id").collect()
    assert sum(len(r.spans) for r in rows[200:260]) >= 50 and not any(r.spans for r in rows[260:])


def test_redaction_leaves_no_base_span(spark):
    docs = frame(spark, [t for t in TEXTS if t is None or len(t) < 2000])
    rows = pii.redact(docs, pii.fit(docs)).orderBy("doc_id").collect()
    assert all(not base_spans(r.text) for r in rows) and rows[0].text == "" and rows[1].text is None
    clean = frame(spark, ["nothing here 12 34", "x"])
    assert [r.text for r in pii.redact(clean, pii.fit(clean)).orderBy("doc_id").collect()] == ["nothing here 12 34", "x"]


def test_empty_table_repeated_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(None, "a@b.c", 1), (None, "a@b.c", 1)], "doc_id long, text string, spans int")
    rows = pii.annotate(docs, pii.fit(docs)).collect()
    assert [len(r.spans) for r in rows] == [1, 1]
    assert pii.annotate(docs.limit(0), pii.fit(docs.limit(0))).collect() == []


def test_query(spark, tmp_path):
    frame(spark, TEXTS).write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op2_pii(spark, str(tmp_path)).collect():
        base = base_spans(TEXTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
