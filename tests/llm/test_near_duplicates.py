import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm import jaccard, line_dedup, queries
from docloom.llm.components import components

from . import helpers


def varied(rng, words, n):
    """Texts in families of near copies, with edits of many sizes, and unrelated ones that share a passage."""
    passage = [rng.choice(words) for _ in range(30)]
    texts = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 40, 120]))]
        texts.append(text)
        for _ in range(rng.randint(0, 6)):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
        if rng.random() < 0.3:
            texts.append([rng.choice(words) for _ in range(rng.choice([3, 10]))] + passage)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_links(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t ", "One two", "one  TWO", "é É", *varied(rng, words, 40)]
    docs = spark.createDataFrame([(i + 10, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_shingles string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert found == helpers.jaccard_components([(i + 10, t) for i, t in enumerate(texts)])


def test_one_template_with_many_edits(spark):
    """The case that pairs of a list would make quadratic: all near one pivot, few linked to each other."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    template = [rng.choice(words) for _ in range(100)]
    texts = []
    for _ in range(120):
        copy = list(template)
        for at in rng.sample(range(100), rng.choice([0, 1, 2, 3, 4, 6])):
            copy[at] = rng.choice(words) if rng.random() < 0.7 else "common"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert found == helpers.jaccard_components(list(enumerate(texts)))


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, None)], "doc_id long, text string")
    rows = jaccard.jaccard_components(docs).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in rows) == [(0, 2, 5), (5, 2, 5), (5, 2, 5), (7, 0, 7)]
    assert jaccard.jaccard_components(docs.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 230)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert found == {n: c for n, c in helpers.components({x for p in links for x in p}, links).items() if n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def normal(line):
    return " ".join("".join(c if c.isalnum() else " " for c in line.lower()).split())


def test_repeated_and_similar_lines_stay_once(spark):
    long = "the quick brown fox jumps over the lazy dog near the old river bank every single morning in early spring"
    near = long.replace("quick", "quicc")
    other = "a completely different sentence about ships and harbours and the weather that sailors talk about at night"
    texts = {1: f"{long}\nshort one\n{other}", 2: f"{near}\nshort one\nunique words in here", 3: f"{long.upper()}!\nthree word line", 4: "Three  word, line\n\nok", 5: None, 6: ""}
    docs = spark.createDataFrame([(k, v, "z") for k, v in texts.items()], "doc_id long, text string, n_lines string")
    rows = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert rows[1].text == texts[1] and rows[1].n_removed == 0
    assert rows[2].text == "short one\nunique words in here" and rows[2].n_removed == 1
    assert rows[3].text == "three word line" and rows[3].n_removed == 1
    assert rows[4].text == "\nok" and (rows[4].n_lines, rows[4].n_removed) == (3, 1)
    assert rows[5].text is None and rows[5].n_lines == 0 and rows[6].text == "" and rows[6].n_lines == 1


def test_line_dedup_against_brute_force(spark):
    """Exact repeats are all found; a removed line has a partner of the demanded similarity; nothing else goes."""
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("al", "be", "co", "du", "en") for b in ("ra", "si", "to", "ul", "vek", "war")]
    lines = [" ".join(rng.choice(words) for _ in range(rng.choice([2, 3, 9, 20, 60]))) for _ in range(60)]
    texts = []
    for _ in range(60):
        own = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(lines)
            if rng.random() < 0.3:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("xyz ") + line[at + 1 :]
            own.append(line.title() if rng.random() < 0.2 else line)
        texts.append("\n".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    places = [(i, p, normal(line)) for i, t in enumerate(texts) for p, line in enumerate(t.split("\n"))]
    seen, exact_repeats = set(), 0
    for _, _, line in places:
        exact_repeats += line in seen and len(line.split()) >= 3
        seen.add(line)
    assert sum(r.n_removed for r in rows.values()) >= exact_repeats
    kept = {}
    for i, t in enumerate(texts):
        left = rows[i].text.split("\n") if rows[i].n_lines > rows[i].n_removed else []
        assert len(left) == rows[i].n_lines - rows[i].n_removed
        for line in left:
            kept[normal(line)] = kept.get(normal(line), 0) + 1
    assert all(n == 1 for line, n in kept.items() if len(line.split()) >= 3)
    for line in {x for _, _, x in places} - kept.keys():  # went altogether, so a similar line has to be there
        assert any(x != line and helpers.edit_distance(line, x) <= max(len(x), len(line)) * 0.1 + 1e-9 for _, _, x in places)


def test_line_dedup_edges(spark):
    docs = spark.createDataFrame([(None, "one two three\nx"), (None, "one two three\nx"), (2, "One two three.\ny")], "doc_id long, text string")
    rows = line_dedup.line_dedup(docs).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [r.text for r in rows] == ["one two three\nx", "one two three\nx", "y"]
    assert line_dedup.line_dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("low, high, least", [(20, 29, 1.0), (30, 53, 1.0), (54, 99, 0.85), (100, 199, 0.9), (200, 400, 0.95)])
def test_line_dedup_recall_by_length(spark, low, high, least):
    """Of pairs with as many edits as the similarity allows, all of the short ones meet and nearly all of the longer ones."""
    rng = random.Random(low)
    made = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") if i % 6 else " " for i in range(n)).strip()
    pairs = []
    while len(pairs) < 80:
        a = b = made(rng.randint(low, high))
        for _ in range(len(a) // 10):
            at = rng.randrange(len(b))
            b = b[:at] + rng.choice(["", "q", "q" + b[at]]) + b[at + 1 :]
        if normal(b) != a and helpers.edit_distance(a, normal(b)) <= max(len(a), len(normal(b))) // 10:
            pairs.append((a, b))
    docs = spark.createDataFrame([(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)], "doc_id long, text string")
    rows = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(docs).collect()}
    assert not any(rows[2 * i] for i in range(80))
    assert sum(rows[2 * i + 1] for i in range(80)) >= least * 80


def test_lines_of_few_words(spark, tmp_path):
    """Lines of one or two words, and long ones without spaces, are deduplicated too by the query and the pipeline."""
    chinese = "敏捷的棕色狐狸在清晨跳过了河岸边那只懒惰的老狗然后消失在远处的树林里"
    texts = ["Les.\nand ornd\n" + chinese, "les\nAnd ornd.\n" + chinese.replace("清", "早"), "new fox here now\n--", "new fix here now\n--"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.n_removed for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()} == {0: 0, 1: 3, 2: 0, 3: 1}
    left = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path)).collect()}
    assert left == {0: texts[0], 2: texts[2]}  # of the others no word is left
