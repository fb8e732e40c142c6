import random

from pyspark.sql import functions as F

from docloom.operators.html import Selector, select_texts
from docloom.operators.parse import JUDGMENT, WEB, parse_cases
from docloom.operators.search import dense_topk
from docloom.operators.store import Collection
from docloom.operators.vector_index import VectorIndex, vector_topk
from docloom.plans import catalogue

PAGE = "<nav><a>x&amp</a></nav><article><h1>A&amp;&amp</h1><p>28.68.191.238 is &notit; R&ampD &#38;lt &lt;b</p><p>A. Name, J. -</p></article>"


def page(spark, profile):
    return parse_cases(spark.createDataFrame([(1, "t", PAGE, 0)], "file_name long, ftype string, html string, flag int"), profile).first()


def test_web_pages_keep_open_references_and_have_no_numbers(spark):
    web, judgment = page(spark, WEB), page(spark, JUDGMENT)
    assert (web.title, web.acts_referred) == ("A&&amp", ["x&amp"])
    assert [tuple(p) for p in web.paragraphs] == [(None, "28.68.191.238 is &notit; R&ampD &lt <b", "p", "main"), (None, "A. Name, J. -", "p", "main")]
    assert judgment.paragraphs == []
    body = select_texts(spark.createDataFrame([(PAGE,)], "html string"), "html", {"t": Selector("h1", decodes=1)})
    assert body.first().t[0].text == "A&&"  # as HTML5 has it


def test_elements_are_found_once_and_below_their_ancestors(spark):
    html = "<div class='a B'><p id=x class='b c'>1</p><span><p class=c>2</p></span></div><p class=c>3</p>"
    wanted = {"two": Selector(".b, .c"), "below": Selector("div .c"), "id": Selector("#x, p"), "inner": Selector("span", inner="p", closest="div")}
    row = select_texts(spark.createDataFrame([(html,)], "html string"), "html", wanted).first()
    assert [[x.text for x in row[c]] for c in wanted] == [["12", "1", "2", "3"], ["1", "2"], ["1", "2", "3"], ["1", "2"]]


def test_judgments_are_parsed_by_many_tasks(spark):
    assert catalogue._judgments(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 8


def test_exact_search_of_an_index(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * (9 if rng.random() < 0.02 else 1) for _ in range(8)]) for i in range(900)]
    rows += [(900 + i, rows[7][1]) for i in range(20)]  # ties, by id
    collection = Collection(spark, f"{tmp_path}/c", "id", 100)
    collection.upsert(spark.createDataFrame(rows, "id long, dense array<double>"))
    VectorIndex.build(collection, lists=30, least_rows=1)
    collection.upsert(spark.createDataFrame([(5, rows[7][1]), (7, rows[8][1])], "id long, dense array<double>"))
    collection.delete(F.col("id") >= 880)  # their entries stay in the lists
    index = VectorIndex.of(collection)
    index.settings["probes"] = 1
    for query in (rows[7][1], [1.0] * 8):
        wanted = [tuple(r) for r in dense_topk(collection.read(), query, 60, "id", "dense").collect()]
        assert [tuple(r) for r in index.exact(query, 60).collect()] == wanted
    assert [tuple(r) for r in vector_topk(collection, query, 60, exact=True).collect()] == wanted
    assert [tuple(r) for r in index.topk(query, 60, oversample=1).collect()] != wanted
