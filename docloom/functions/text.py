"""String, number and date scalars as Column expressions.

White space is the ECMAScript class, written out, since Java's ``\\s`` is ASCII only.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space. The escapes mean the same to Java and RE2.
SPACE = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
#: The numbers of known courts.
COURTS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 24, 25, 26, 27, 28, 29, 30, 40, 82, 83, 84, 91, 97, 98, 104]
SERIALS = 100_000


#: What a character reference looks like.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: References that come first, as names are looked up in order.
FREQUENT = ["amp;", "nbsp;", "lt;", "gt;", "quot;", "apos;"]


def decode_entities(value: Column | str) -> Column:
    """HTML character references decoded once, as HTML5 has them; null stays null. A Column expression: references and what lies
    between them are taken apart, looked up and joined again."""
    text = F.col(value) if isinstance(value, str) else value
    between = F.split(text, REFERENCE, -1)

    def behind(s: Column) -> Column:
        each = F.transform(s["found"], lambda one: F.get(s["decoded"], (F.array_position(s["names"], one) - 1).cast("int")))
        return F.zip_with(each, F.slice(between, 2, F.size(s["found"])), lambda one, rest: F.concat(one, rest))

    # Each step is the argument of a function, so it is computed once a text; different references are decoded once.
    found = F.transform(F.array(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))), lambda f: F.struct(f.alias("found"), F.array_distinct(f).alias("names")))
    known = F.transform(found, lambda s: F.struct(s["found"].alias("found"), s["names"].alias("names"), F.transform(s["names"], _decoded).alias("decoded")))
    joined = F.get(F.transform(known, lambda s: F.array_join(behind(s), "")), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.concat(F.get(between, F.lit(0)), joined)).otherwise(text)


def _decoded(reference: Column) -> Column:
    name = F.substring(reference, 2, 40)
    known = F.from_json(F.lit(json.dumps({n: html5[n] for n in [*FREQUENT, *sorted(html5.keys() - set(FREQUENT))]})), "map<string,string>")
    open_ended = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))  # names that need no semicolon
    start = F.regexp_extract(name, f"^({open_ended})", 1)
    named = F.coalesce(F.try_element_at(known, name), F.when(start != "", F.concat(F.try_element_at(known, start), F.substr(name, F.length(start) + 1))), reference)
    return F.when(name.startswith("#"), _numbered(reference)).otherwise(named)


def _numbered(reference: Column) -> Column:
    """The character of a number. Numbers of Windows-1252 are that page's, impossible ones the replacement character, control
    and no characters nothing."""
    decimal = reference.rlike("^&#[0-9]")
    digits = F.regexp_replace(F.regexp_extract(reference, "^&#[xX]?([0-9a-fA-F]+)", 1), "^0+", "")
    number = F.when(digits == "", 0).when(F.length(digits) > 7, 0x110000).otherwise(F.when(decimal, F.conv(digits, 10, 10)).otherwise(F.conv(digits, 16, 10)).cast("int"))
    page = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]
    old = F.get(F.array(*map(F.lit, page)), number - 0x80)
    gone = number.between(0x1, 0x8) | (number == 0xB) | number.between(0xE, 0x1F) | (number == 0x7F) | number.between(0xFDD0, 0xFDEF) | F.pmod(number, F.lit(0x10000)).isin(0xFFFE, 0xFFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    impossible = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    return F.when(impossible, "\ufffd").when(number.between(0x80, 0x9F), old).when(gone, "").otherwise(character)


def _text(value: Column | str) -> Column:
    return F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit(""))


def strip(value: Column | str) -> Column:
    return F.regexp_replace(_text(value), f"^[{SPACE}]+|[{SPACE}]+$", "")


def normalize_inline(value: Column | str, decode: bool = False) -> Column:
    """White space to single spaces, none at the ends; null is empty. ``decode``: character references first (texts out of a
    parsed document have been decoded)."""
    text = decode_entities(_text(value)) if decode else _text(value)
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def normalize_lines(value: Column | str) -> Column:
    """Keeps line ends, at most two in a row; other runs of blanks become one space."""
    spaced = F.regexp_replace(F.regexp_replace(_text(value), r"\x{A0}", " "), r"[ \t]+", " ")
    lines = F.regexp_replace(spaced, f"[{SPACE}]*\\n[{SPACE}]*", "\n")
    return strip(F.regexp_replace(lines, r"\n{3,}", "\n\n"))


def _items(parts: Column) -> Column:
    return F.filter(parts, lambda x: x != "")


def comma_list(value: Column | str) -> Column:
    """Items between commas, trimmed, empty ones left out, repeated ones kept."""
    return _items(F.split(normalize_inline(value), " ?, ?"))


def loose_list(value: Column | str) -> Column:
    """Items between ``;``, ``|`` or ``,`` (of several blanks normalisation leaves one, so they separate nothing)."""
    return _items(F.transform(F.split(normalize_inline(value), r" ?; ?| ?\| ?| ?, ?"), lambda x: F.regexp_replace(F.trim(x), "^[,;]+|[,;]+$", "")))


def paragraph_number(value: Column | str) -> Column:
    """``struct(para_no, text)`` from ``[n] ...``, ``(n) ...`` or ``n. ...``. Numbers of over 18 digits don't count as such."""
    text = _text(value)
    # fixed values: the forms of a number, in the order in which they are tried
    forms = [rf"(?s)^\[(\d{{1,18}})\][{SPACE}]*(.*)$", rf"(?s)^\((\d{{1,18}})\)[{SPACE}]*(.*)$", rf"(?s)^(\d{{1,18}})\.[{SPACE}]*(.*)$"]
    out = plain = F.struct(F.lit(None).cast("long").alias("para_no"), normalize_inline(text).alias("text"))
    for form in reversed(forms):
        found = F.struct(F.regexp_extract(text, form, 1).try_cast("long").alias("para_no"), normalize_inline(F.regexp_extract(text, form, 2)).alias("text"))
        out = F.when(text.rlike(form), found).otherwise(out)
    return F.when(text.rlike(r"^[\[(]?\d"), out).otherwise(plain)  # most texts begin without a number


def words(value: Column | str) -> Column:
    return _items(F.split(_text(value), f"[{SPACE}]+"))


def word_count(value: Column | str) -> Column:
    return F.size(words(value))


def word_windows(value: Column | str, most: int) -> Column:
    """Windows of ``most`` words joined by one space; a text that fits stays one, stripped."""

    def windows(found: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.size(found) - 1, F.lit(most)), lambda i: F.array_join(F.slice(found, i + 1, most), " "))
        return F.when(F.size(found) <= most, F.array(strip(value))).otherwise(cut)

    return F.element_at(F.transform(F.array(words(value)), windows), 1)  # the words are a function's argument, so a text is split once


def compact(values: Column | str) -> Column:
    """Trimmed non-empty items joined by ``, ``; null is empty."""
    items = F.coalesce(F.col(values) if isinstance(values, str) else values, F.array().cast("array<string>"))
    return F.array_join(_items(F.transform(items, strip)), ", ")


#: The labels of a sparse text's lines, by column.
SPARSE_LABELS = {
    "title": "title", "citation": "citation", "case_no": "case no", "case_type": "case type", "court": "court",
    "date_of_decision": "date of decision", "subject": "subject", "final_decision": "final decision",
}
SPARSE_LISTS = {"judges": "judges", "acts_referred": "acts referred", "equivalent_citations": "equivalent citations"}


def sparse_text(text: Column | str = "text", labels: dict[str, str] | None = None, lists: dict[str, str] | None = None) -> Column:
    """Labelled lines of the filled metadata columns, then the text."""
    labels, lists = SPARSE_LABELS if labels is None else labels, SPARSE_LISTS if lists is None else lists
    lines = [F.when(F.col(c) != "", F.concat(F.lit(f"{label}: "), F.col(c))) for c, label in labels.items()]
    lines += [F.when(F.size(c) > 0, F.concat(F.lit(f"{label}: "), compact(c))) for c, label in lists.items()]
    return F.concat_ws("\n", *lines, F.concat(F.lit("text: "), _text(text)))


def point_id(case_id: Column | str, chunk_index: Column | str) -> Column:
    one, two = (F.col(c) if isinstance(c, str) else c for c in (case_id, chunk_index))
    return one.cast("long") * SERIALS + two.cast("long")


def chunk_id(case_id: Column | str, chunk_index: Column | str) -> Column:
    return F.concat_ws("_", case_id, chunk_index)


def numeric_string(value: Column | str) -> Column:
    """Digits without their commas; null if anything else is in the value."""
    raw = strip(F.regexp_replace(_text(value), ",", ""))
    return F.when(raw.rlike("^[0-9]+$"), raw)


def court_id(value: Column | str) -> Column:
    """The known court that a running number belongs to, else null."""
    number = numeric_string(value).try_cast("decimal(38,0)")
    court = F.floor(number / SERIALS).try_cast("long")
    return F.when(court.isin(COURTS), court)


def existing_number(value: Column | str) -> Column:
    """A stored number, also one stored as digits; else null."""
    raw = strip(value)
    return F.when(raw.rlike(r"^[0-9]+$"), raw.try_cast("long"))


def decision_date(value: Column | str) -> Column:
    """``struct(decision_date, decision_year)`` from texts like ``18 January 1949``; nulls for anything else."""
    form = f"^([0-9]{{1,2}})[{SPACE}]+([A-Za-z]+)[{SPACE}]+([0-9]{{4}})$"
    raw = strip(value)
    plain = F.concat_ws(" ", *[F.regexp_extract(raw, form, i) for i in (1, 2, 3)])
    day = F.when(raw.rlike(form) & (F.regexp_extract(raw, form, 3) >= "0100"), F.try_to_date(plain, "d MMMM yyyy"))
    return F.struct(day.alias("decision_date"), F.year(day).alias("decision_year"))


def number(value: Column | str) -> Column:
    """A finite decimal number, else null."""
    raw = strip(value)
    return F.when(raw.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]{1,2})?$"), raw.try_cast("double"))


def prefix(value: Column | str, characters: int) -> Column:
    return F.substring(_text(value), 1, characters)


def json_bytes(*columns: Column | str) -> Column:
    """UTF-8 bytes of the columns as one JSON object, nulls included."""
    return F.octet_length(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def backoff_ms(attempt: Column | str, base: int, most: int) -> Column:
    """Doubling delays: ``base`` for the first attempt, ``most`` at the end."""
    n = F.col(attempt) if isinstance(attempt, str) else attempt
    return F.least(F.lit(base) * F.pow(F.lit(2.0), n - 1), F.lit(float(most))).cast("long")


def adaptive_batch(chunks: Column | str) -> Column:
    """Texts in one embedding request, fewer for cases of many chunks."""
    n = F.col(chunks) if isinstance(chunks, str) else chunks
    return F.when(n > 500, 8).when(n > 200, 12).otherwise(24)
