import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import chunk as C
from docloom.operators.html import Selector, _Reader
from docloom.operators.parse import JUDGMENT, parse_cases, selectors

FULL = """<html><style>.x{}</style><p class="judgtitle">A <b>v</b>.<br>B&amp;C</p><div class="highcourt">High Court</div><p class=judgdate>Date of Decision : 1 March 2000
<p class="citations">Citation: X<br>Y</p><p class="judges">Hon'ble Judges : A, B,, C</p><p class="apptype">Case Type: Civil</p><p class="appealno">Case No: 5</p>
<p class="fd">Subject: Land</p><p class="fd">Final Decision :</p><p class="acts">Acts Referred: <a>Act 1</a><a>Act 2</a><a>Act 1</a></p><p class="eqcitations">Eq. Citations: C1, C2</p>
<p class="advocate">Advocates: D</p><p>Cited <a id="aCaseCited">in</a> <b>12</b></p><p class="judgpara">Judgement Text :</p><p class="judgpara">A. Rao, J. -</p>
<p class="judgpara">[1] First&nbsp;<a href=x>link</a>.<script>no()</script></p><p class="judgspara">(a) sub</p><p class="judgpara judgspara">2. second</p><p class="judgpara">[1] First link.</p><p class="judgpara">[9] First link.</p></html>"""


def parsed(spark, *documents):
    rows = [(i + 1, "t", html, 0) for i, html in enumerate(documents)]
    return parse_cases(spark.createDataFrame(rows, "file_name long, ftype string, html string, flag int"), JUDGMENT).orderBy("case_id").collect()


def test_full_metadata(spark):
    case = parsed(spark, FULL)[0]
    assert (case.title, case.court, case.date_of_decision, case.citation) == ("A v . B&C", "High Court", "1 March 2000", "XY")
    assert (case.judges, case.case_type, case.case_no, case.subject, case.final_decision) == (["A", "B", "C"], "Civil", "5", "Land", "")
    assert (case.acts_referred, case.equivalent_citations, case.advocates, case.cited, case.warnings) == (["Act 1", "Act 2"], ["C1", "C2"], ["D"], 12.0, [])
    assert [tuple(p) for p in case.paragraphs] == [
        (1, "A. Rao, J. - First link.", "judgpara", "main"), (None, "(a) sub", "judgspara", "subpoint"), (2, "second", "judgspara", "subpoint"), (9, "First link.", "judgpara", "main"),
    ]
    assert case.full_text.startswith("[1] A. Rao, J. - First link.\n\n(a) sub")


def test_empty_and_missing(spark):
    empty, null, acts = parsed(spark, "", None, '<p class="acts">Acts referred : A; B | C</p><p class="cited">x</p>')
    for case in (empty, null):
        assert case.warnings == ["no title found", "no court found", "no citation found", "no paragraphs found"] and case.paragraphs == [] and case.cited is None
    assert acts.acts_referred == ["A", "B", "C"]


@pytest.mark.parametrize(
    ("weights", "target", "wanted"),
    [([], 600, []), ([100], 600, [(0, 1)]), ([300, 300], 600, [(0, 2)]), ([300, 500, 500], 600, [(0, 1), (1, 2), (2, 3)]), ([200] * 4, 600, [(0, 3), (2, 4)]), ([100, 100, 599], 600, [(0, 2), (1, 2), (2, 3)])],
)
def test_spans(weights, target, wanted):
    assert list(C.spans(weights, target, 1)) == wanted


def test_spans_cover_everything():
    rng = random.Random(1)
    for _ in range(300):
        weights = [rng.randint(0, 50) for _ in range(rng.randint(1, 30))]
        most, overlap = rng.randint(1, 90), rng.randint(0, 3)
        found = list(C.spans(weights, most, overlap))
        assert sorted({i for a, b in found for i in range(a, b)}) == list(range(len(weights)))
        assert all(b - a == 1 or sum(weights[a:b]) <= most for a, b in found)


def test_chunk_records(spark):
    docs = spark.createDataFrame([(1, " ".join(["w"] * 7) + "\nx y\n\n z "), (2, ""), (3, None)], "case_id long, text string")
    rows = C.chunk(docs.select("case_id", C.line_paragraphs("text").alias("paragraphs")), target_words=3).orderBy("chunk_index").collect()
    assert [(r.chunk_id, r.paragraph_start, r.paragraph_end, r.text, r.word_count) for r in rows] == [
        ("1_0", 1, 1, "w w w", 3), ("1_1", 2, 2, "w w w", 3), ("1_2", 3, 4, "w\n\nx y", 3), ("1_3", 4, 5, "x y\n\nz", 3),
    ]
    with pytest.raises(ValueError):
        C.chunk(docs, target_words=0)


def test_chunk_numbers_and_roles(spark):
    row = spark.createDataFrame([(1, [(4, "a b", "judgpara", "main"), (None, "c", "judgspara", "subpoint")])], "case_id long, paragraphs array<struct<para_no:long,text:string,source_class:string,role:string>>")
    found = C.chunk(row).first()
    assert (found.text, found.has_subpoints, found.source_paragraph_types) == ("[4] a b\n\nc", True, ["main", "subpoint"])
    assert C.totals(C.chunk(row)).first().asDict() == {"cases": 1, "chunks": 1}
    assert C.large_cases(C.chunk(row), over=0).select(F.col("chunks")).first().chunks == 1


def test_pages_of_one_template_are_parsed_once(monkeypatch):
    wanted = [*selectors(JUDGMENT).values(), Selector("h1", "tags"), Selector("p", "space", 1)]
    texts = ["", " ", "a", "x &amp; y", "&amp;lt;", "a > b", "one\n two", "﻿", "&", "&am", "&copy 1", '"', "'", "a < b", "&#65;", "-->", "&amp;0"]
    layouts = [
        '{}<h1>{}</h1><p class="judgtitle FD">{}<br/>{}<b>{}</b><p class="judgpara">{}<script>{}</script>{}</p>{}',
        '{}<div class="acts">{}<a>{}</a>{}</div><p><a id="aCaseCited">{}</a><b>{}</b></p><ul><li>{}<li>{}</ul>{}',
        "{}<p class='judgpara'>{}<!-- {} -->{}<p title=\"1 > 2\" class=\"fd\">{}</p ><style>{}</p>{}</style>{}<b{}",
    ]
    rnd = random.Random(3)
    pages = [rnd.choice(layouts).format(*rnd.choices(texts, k=9)) for _ in range(600)]
    for open_references in (True, False):
        found = _Reader(wanted, open_references)
        assert [found(page) for page in pages] == [_Reader(wanted, open_references)(page) for page in pages]  # a new one parses each
    calls = []
    parsed_alone = _Reader.parsed
    monkeypatch.setattr(_Reader, "parsed", lambda self, page: (calls.append(page), parsed_alone(self, page))[1])
    read = _Reader(wanted, True)
    for i in range(300):
        assert read(layouts[0].format(*(f"{i} {k}" for k in range(9))))[-2] == [(f"{i} 1", "")]
    assert len(calls) == 2  # the first page, and its tags when they came again


def test_only_what_wanted_columns_are_made_of_is_looked_for(spark):
    assert set(selectors(JUDGMENT, ["case_id", "judges", "subject"])) == {"docloom_judges", "docloom_block"}
    assert set(selectors(JUDGMENT)) >= {"docloom_title", "docloom_paragraphs", "docloom_acts", "docloom_cited"}
    raw = spark.createDataFrame([(1, "t", FULL, 0), (2, "t", None, 0), (3, "t", "<p>nothing", 0)], "file_name long, ftype string, html string, flag int")
    whole = parse_cases(raw).orderBy("case_id")
    for wanted in (["case_id", "title", "cited", "subject"], ["judges", "acts_referred", "case_id"], ["warnings", "case_id"], ["full_text", "flag", "case_id"]):
        assert parse_cases(raw, wanted=wanted).orderBy("case_id").collect() == whole.select(*wanted).collect()
