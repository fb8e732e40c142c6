import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from docloom.llm import license_scan as L
from docloom.llm import toxicity, url_filter


def test_licences_by_digest(spark):
    changed = "Copyright (c) 2020 Some One\n" + L.MIT.upper().replace(",", " ;") + "\n\n"
    texts = [L.MIT, changed, L.MIT + " and more", "x\n  Released under the MIT Licence!\nLicensed under CC BY-NC 4.0.", None, "", "© 2001 a\n(c) b", L.LICENCES["BSD-3-Clause"]]
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    notices = spark.createDataFrame([(v, k) for k, v in L.NOTICES.items()], "licence string, text string")
    rows = L.license_scan(docs, L.known_table(spark, L.LICENCES), notices).orderBy("doc_id").collect()
    assert [r.licence for r in rows] == ["MIT", "MIT", None, None, None, None, None, "BSD-3-Clause"]
    assert [r.notices for r in rows] == [[], [], [], ["CC-BY-NC-4.0", "MIT"], [], [], [], []]
    assert rows[0].digest == rows[1].digest and rows[4].digest == rows[6].digest and rows[0].doc_id == 0


def test_licences_as_published(spark):
    """With titles, holders and bullets, as the usual files have them; the digest stays that of the whole text."""
    holder = "Copyright (c) 2001, Some One\nAll rights reserved.\n\n"
    starred = L.LICENCES["BSD-3-Clause"].replace("\n1. ", "\n* ").replace("\n2. ", "\n* ").replace("\n3. ", "\n* ")
    texts = {
        "MIT": ["MIT License\n\n" + holder + L.MIT, "The MIT License (MIT)\n\n" + holder + L.MIT, "# The MIT License\n" + L.MIT],
        "BSD-3-Clause": ["BSD 3-Clause License\n\n" + holder + L.LICENCES["BSD-3-Clause"], holder + starred, "The 3-Clause BSD License\n" + starred.replace("\n* ", "\n  - ")],
        "BSD-2-Clause": ["BSD 2-Clause License\n" + holder + L.LICENCES["BSD-2-Clause"]],
        "ISC": ["ISC License\n\n" + holder + L.LICENCES["ISC"], "ISC License (ISC)\n" + L.LICENCES["ISC"]],
        "0BSD": ["BSD Zero Clause License\n\n" + holder + L.LICENCES["0BSD"]],
        "Zlib": ["zlib License\n\n" + holder + L.ZLIB],
        None: ["MIT License", "1. \n* ", "BSD 3-Clause License\n" + L.MIT.replace("free of charge", "at a charge")],
    }
    wanted = [(name, text) for name, forms in texts.items() for text in forms]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(wanted)], "doc_id long, text string")
    rows = L.license_scan(docs, L.known_table(spark, L.LICENCES), L.known_table(spark, {})).withColumn("plain", L.digest(F.col("text"))).orderBy("doc_id").collect()
    assert [r.licence for r in rows] == [name for name, _ in wanted]
    assert all(r.digest == r.plain for r in rows)


LONGER = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="needs the published texts")
def test_longer_licences(spark):
    rows = [(name, open(f"/usr/share/common-licenses/{file}").read()) for name, file in LONGER.items()]
    found = L.license_scan(spark.createDataFrame(rows, "name string, text string"), L.known_table(spark, L.LICENCES), L.known_table(spark, {})).collect()
    assert len(found) == len(LONGER) and all(r.licence == r.name for r in found)


def test_a_text_and_its_lines_have_one_form(spark):
    """The forms made together are those of the text, of its body and of each line by itself; a text is worked through once."""
    texts = ["Copyright A\ncopyright b\nThe  LICENCE, of\ncc by nc\n\n(c) x", "a cc by\nnc work\nnon-commercial GNU\nGPL gnu gpl", "MIT License\n\n1. Same text\n* Copyright 2020 x\n(a) ΣΟΦΟΣ\nΣ", "", "\n", "é\u00a0É\r\nfavour  favourite\n", "not a copyright line\n# © here\nend"]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    line = L.digest(F.col("line"))
    each = df.select("text", F.explode(F.split("text", "\n")).alias("line")).groupBy("text").agg(F.collect_set(line).alias("lines"))
    want = {r.text: r for r in df.select("text", L.digest(F.col("text")).alias("digest"), L.body_digest(F.col("text")).alias("body")).join(each, "text").collect()}
    keys = {r.key: r.text for r in df.select("text", F.xxhash64("text").alias("key")).collect()}
    found = L.told(df)
    none = hashlib.md5(b"").hexdigest()
    for r in found.collect():
        w = want[keys[r.key]]
        assert (r.digest, r.body, set(r.lines)) == (w.digest, w.body, set(w.lines) - {none}), w.text


def test_licence_edges(spark):
    known = spark.createDataFrame([("b", "Same  text"), ("a", "same text."), ("c", "  "), (None, None)], "licence string, text string")
    docs = spark.createDataFrame([(None, "SAME TEXT"), (None, "SAME TEXT"), (1, " ")], "doc_id long, text string")
    rows = L.license_scan(docs, known, known).collect()
    assert sorted((r.doc_id or 0, r.licence or "") for r in rows) == [(0, "a"), (0, "a"), (1, "")]
    assert L.license_scan(docs.limit(0), known, known.limit(0)).collect() == []


URLS = ["http://Ads.example.org/es/1?x", "https://example.org/en/12", "http://a.b.com/de/", "http://com/fr/", "ftp://x.net#f", "//x", None, "", "http://my-ads.net/a", "http://sub.my-ads.net/a", "http://x.org", "http:///p", "a://b://c/d"]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    rows = url_filter.url_filter(pages).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("ads.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("a.b.com", "/de/", "com/de/", "block"), ("com", "/fr/", "com/fr/", "allow"),
        ("x.net", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("my-ads.net", "/a", None, "block"), ("sub.my-ads.net", "/a", None, "block"),
        ("x.org", "", None, "allow"), ("", "/p", None, "allow"), ("b:", "//c/d", None, "allow"),
    ]
    assert url_filter.url_filter(pages.limit(0)).collect() == []


def test_cascade_is_exact(spark):
    rng = random.Random(1)
    keys = [f"h{i}.net" for i in range(3000)]
    listed = set(rng.sample(keys, 700))
    universe = spark.createDataFrame([(k,) for k in [*keys, None, keys[0]]], "key string")
    cascade = url_filter.Cascade(url_filter.marked_keys(spark.createDataFrame([(k,) for k in listed], "key string"), universe))
    assert len(cascade.levels) > 1
    found = {r.key for r in universe.where("key IS NOT NULL").where(cascade.listed(universe["key"])).collect()}
    assert found == listed


def test_filter_bytes_are_those_of_its_keys(spark):
    """Pages with gaps before, between and behind nonzero bytes, over several pages."""
    keys = spark.createDataFrame([(f"k{i}",) for i in range(40)], "key string")
    bits = 8 * 3 * url_filter.PAGE_BYTES
    level = url_filter.encode(keys, 0, bits, 3)
    wanted = bytearray(bits // 8)
    for row in keys.select(*(url_filter.position(F.col("key"), 0, i, bits) for i in range(3))).collect():
        for p in row:
            wanted[p // 8] |= 1 << p % 8
    assert level.data == bytes(wanted) and url_filter.encode(keys.limit(0), 0, 64, 3).data == bytes(8)


def test_a_list_beyond_the_bound_is_judged_in_parts(spark):
    rng = random.Random(6)
    hosts = [f"h{i}.x{i % 7}.net" for i in range(500)]
    listed = set(rng.sample(hosts, 120)) | {"x3.net", "elsewhere.com"}
    pages = spark.createDataFrame([(i, f"http://{rng.choice(hosts)}/a", i, i) for i in range(800)], "page_id long, url string, verdict long, docloom_listed long")
    assert url_filter.parts_for(122, 400, 400) == 4
    whole, parts = (url_filter.url_filter(pages, spark.createDataFrame([(k,) for k in listed], "key string"), most_bits=m) for m in (1 << 28, 400))
    assert parts.columns == whole.columns and sorted(map(tuple, parts.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    for r in parts.collect():
        assert r.verdict == ("block" if r.host in listed or r.host.endswith(".x3.net") else "allow") and r.docloom_listed == r.page_id


def test_very_long_urls(spark):
    pages = spark.createDataFrame([(1, "http://ads.net/" + "a" * 1_000_000), (2, "http://" + "b" * 1_000_000)], "page_id long, url string")
    rows = url_filter.url_filter(pages).orderBy("page_id").collect()
    assert [(r.verdict, len(r.host), len(r.path)) for r in rows] == [("block", 7, 1_000_001), ("allow", 1_000_000, 0)]


def labelled(spark, n, seed=0):
    rng = random.Random(seed)
    calm, bad = [f"calm{i}" for i in range(60)], [f"vile{i}" for i in range(12)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        words = [rng.choice(calm) for _ in range(30)] + [rng.choice(bad) for _ in range(4 if toxic else 0)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_neighbours(spark):
    docs, labels = labelled(spark, 600)
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held]
    assert len(held) > 60 and sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_nearest_is_exact():
    rng = random.Random(7)
    examples = [(str(i), i % 2, {f: rng.random() for f in rng.sample(range(40), rng.randint(1, 8))}) for i in range(900)]
    model = toxicity.Model({f"w{i}": (i, 1.0) for i in range(40)}, 0.5, 0.5)
    model.index(examples)
    by_id = {e[0]: e[2] for e in examples}
    for _ in range(40):
        query = {f: rng.random() for f in rng.sample(range(40), 5)}
        at, cosine = model.nearest(query, 10)
        all_ = sorted((-sum(query.get(f, 0) * w for f, w in by_id[key].items()), place) for place, key in enumerate(model.ids))
        assert [round(-x[0], 9) for x in all_[:10]] == [round(c, 9) for c in cosine.tolist()]
        assert len(set(at.tolist())) == 10


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "e"), (None, "", "e"), (2, "x", "e"), (2, "x", "e")], "doc_id long, text string, evidence string")
    labels = spark.createDataFrame([(None, 1), (2, None), (9, 5)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert [(r.score, r.predicted) for r in rows] == [(0.0, 0)] * 4
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).collect() == []
