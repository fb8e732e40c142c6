import datetime
import html
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as X


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column("v").alias("x")).first().x


@pytest.mark.parametrize(("value", "wanted"), [(None, ""), ("  a 　b\t\nc﻿", "a b c"), ("", "")])
def test_normalize_inline(spark, value, wanted):
    assert one(spark, X.normalize_inline, value) == wanted


def test_normalize_lines(spark):
    assert one(spark, X.normalize_lines, " a \t b \n\n\n\n c d ") == "a b\nc d"


def test_decode_entities(spark):
    assert one(spark, X.decode_entities, "a &amp;amp; &lt;") == "a &amp; <" and one(spark, X.decode_entities, None) is None
    assert one(spark, lambda c: X.normalize_inline(c, decode=True), " a&nbsp;&#9; b&amp;nbsp; ") == "a b&nbsp;"


def test_decode_entities_as_the_standard_library(spark):
    r = random.Random(1)
    names = sorted(html5)
    numbers = [0, 1, 8, 9, 10, 13, 0xB, 0x7F, 0x80, 0x81, 0x9F, 0xA0, 0xE9, 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFD, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 10**12]
    pieces = [
        lambda: "&" + r.choice(names), lambda: "&" + r.choice(names).rstrip(";") + r.choice(["", "x", "1;", " ", ";"]), lambda: f"&#{r.choice(numbers)}" + r.choice([";", "", "x"]),
        lambda: f"&#{r.choice('xX')}{'0' * r.randint(0, 9)}{r.choice(numbers):{r.choice('xX')}}" + r.choice([";", "", "g"]), lambda: r.choice(["&", "&&", "&;", "&#;", "&#x;", "& ", "&notit;", "plain", " ", "é\n", "&" + "z" * 40 + ";"]),
    ]
    texts = ["".join(r.choice(pieces)() for _ in range(r.randint(0, 8))) for _ in range(3000)] + [f"&{n}" for n in names]
    found = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.decode_entities("t").alias("d")).collect()
    assert [(texts[x.i], x.d) for x in found if x.d != html.unescape(texts[x.i])] == []


@pytest.mark.parametrize(("value", "wanted"), [("a , b,,a", ["a", "b", "a"]), (None, []), (" , ", [])])
def test_comma_list(spark, value, wanted):
    assert one(spark, X.comma_list, value) == wanted


def test_loose_list(spark):
    assert one(spark, X.loose_list, "a; b | c , d  e") == ["a", "b", "c", "d e"]


@pytest.mark.parametrize(
    ("value", "number", "rest"),
    [("[7] x", 7, "x"), ("(7) x", 7, "x"), ("7. x", 7, "x"), ("[007] x", 7, "x"), ("1.5 percent", 1, "5 percent"), ("[5]", 5, ""), ("x [5]", None, "x [5]"), ("9" * 30 + ". x", None, "9" * 30 + ". x")],
)
def test_paragraph_number(spark, value, number, rest):
    found = one(spark, X.paragraph_number, value)
    assert (found.para_no, found.text) == (number, rest)


def test_word_windows(spark):
    assert one(spark, lambda c: X.word_windows(c, 2), " a b  c ") == ["a b", "c"]
    assert one(spark, lambda c: X.word_windows(c, 3), " a b  c ") == ["a b  c"]
    assert one(spark, X.word_count, "") == 0


def test_sparse_text_leaves_out_empty_lines(spark):
    row = spark.createDataFrame([("t", "", None, ["a ", "", "b"], [])], "title string, citation string, court string, judges array<string>, acts array<string>")
    labels, lists = {"title": "title", "citation": "citation", "court": "court"}, {"judges": "judges", "acts": "acts"}
    assert row.select(X.sparse_text(F.lit("x"), labels, lists).alias("x")).first().x == "title: t\njudges: a, b\ntext: x"


@pytest.mark.parametrize(
    ("value", "court"),
    [("100001", 1), ("199999", 1), ("200001", 2), ("1000001", 10), ("10400001", 104), ("1,00,001", 1), ("", None), (None, None), ("abc", None), ("0", None), ("99999", None), ("2300001", None), ("9" * 37, None)],
)
def test_court_id(spark, value, court):
    assert one(spark, X.court_id, value) == court


@pytest.mark.parametrize(
    ("value", "day"),
    [
        ("14 December 1950", (1950, 12, 14)), ("1 March 2000", (2000, 3, 1)), ("31 February 1950", None), ("", None), (None, None), ("1 mar 2000", None), ("1  MARCH  2000", (2000, 3, 1)),
        (" 1 March 2000 ", (2000, 3, 1)), ("March 1, 2000", None), ("29 February 1900", None), ("29 February 2000", (2000, 2, 29)), ("1 March 0050", None),
    ],
)
def test_decision_date(spark, value, day):
    found = one(spark, X.decision_date, value)
    assert found.decision_date == (day and datetime.date(*day)) and found.decision_year == (day and day[0])


@pytest.mark.parametrize(("value", "wanted"), [("12", 12.0), ("1.5e3", 1500.0), ("1,234", None), ("12d", None), ("Infinity", None), (None, None)])
def test_number(spark, value, wanted):
    assert one(spark, X.number, value) == wanted


def test_large_ids_and_delays(spark):
    row = spark.range(1).select(X.point_id(F.lit(10400001), F.lit(3)).alias("id"), X.backoff_ms(F.lit(9), 2000, 60000).alias("ms"), X.json_bytes(F.lit(None).alias("a"), F.lit("é").alias("b")).alias("n")).first()
    assert (row.id, row.ms, row.n) == (1040000100003, 60000, len('{"a":null,"b":"é"}'.encode()))
