"""Operator 6: URL verdicts from path rules and a Bloom filter cascade. DataFrame functions only.

The cascade (alternating Bloom filters, as in certificate-revocation filters) holds a set of listed
keys exactly with respect to the corpus's whole key universe: level 0 encodes the listed keys, level 1
the unlisted keys that level 0 takes for listed, level 2 the listed keys that level 1 takes in, and so
on until a level has no false positives. Looking a key up reads a few bits and joins nothing.

A filter has about ``FIRST_BITS`` bits per listed key, so its size is known from counts before it is built. Beyond
``MOST_BITS`` the keys are split by a hash into parts with a cascade each, and the rows are judged in one pass for
each part, so that tasks hold one part's cascade at a time, however long the list is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIRST_BITS, FIRST_HASHES, LATER_BITS, LATER_HASHES = 12, 6, 3, 2
#: A level's size in bits above which the keys are split; the share of unlisted keys that level 0 takes in, at most; filter bytes that come to the driver in one row.
MOST_BITS, FALSE_SHARE, PAGE_BYTES = 1 << 28, 0.01, 4096

#: A host label with one of these words, alone or between hyphens, puts the host on the query's list.
LISTED_WORDS = ["ads", "adult", "bets", "casino", "farm", "gambling", "pills", "porn", "spam", "track", "viagra", "xxx"]


@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and all subdomains, ``path`` is a prefix of the url's path."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1)


def suffixes(name: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_of(name: Column, where: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):  # the last `when` put on top wins
        fits = ((name == rule.host) | name.endswith(f".{rule.host}")) & where.startswith(rule.path)
        text = F.when(fits, rule.host + rule.path).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def position(key: Column, level: int, hashed: int, bits: int) -> Column:
    """The ``hashed``-th bit of ``key`` at a level, by double hashing."""
    one, two = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
    return F.pmod(F.shiftright(one, 1) + hashed * F.shiftright(two, 8), F.lit(bits))


@dataclass(frozen=True)
class Level:
    data: bytes
    hashes: int

    def holds(self, key: Column, level: int) -> Column:
        data, out = F.lit(self.data), F.lit(True)
        for i in range(self.hashes):
            p = position(key, level, i, 8 * len(self.data))
            byte = F.conv(F.hex(F.substring(data, F.shiftright(p, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            out = out & (F.getbit(byte, F.pmod(p, F.lit(8)).cast("int")) == 1)
        return out


def encode(keys: DataFrame, level: int, bits: int, hashes: int) -> Level:
    """A Bloom filter of the column ``key``: bytes by bitwise OR, combined before the shuffle, then joined to pages.

    The filter's pages come to the driver, at most ``bits / 8 / PAGE_BYTES`` rows.
    """
    spread = F.array(*[position(F.col("key"), level, i, bits) for i in range(hashes)])
    ones = keys.select(F.explode(spread).alias("p")).select(F.shiftright("p", 3).alias("i"), F.expr("shiftleft(1, cast(pmod(p, 8) AS int))").alias("b"))
    byte = F.struct(F.pmod("i", F.lit(PAGE_BYTES)).cast("int").alias("i"), "b")
    pages = ones.groupBy("i").agg(F.bit_or("b").alias("b")).groupBy(F.floor(F.col("i") / PAGE_BYTES).alias("page")).agg(F.array_sort(F.collect_list(byte)).alias("held"))
    gap = lambda x, at: x["i"] - F.coalesce(F.get("held", at - 1)["i"], F.lit(-1)) - 1
    filled = F.transform("held", lambda x, at: F.concat(F.repeat(F.lit("00"), gap(x, at)), F.lpad(F.hex(x["b"]), 2, "0")))
    data = bytearray(bits // 8)
    for row in pages.select("page", F.unhex(F.array_join(filled, "")).alias("bytes")).collect():
        data[row.page * PAGE_BYTES : row.page * PAGE_BYTES + len(row.bytes)] = row.bytes
    return Level(bytes(data), hashes)


def marked_keys(listed: DataFrame, universe: DataFrame) -> DataFrame:
    """``key, listed``: every key of both (each with one column ``key``) once."""
    universe = universe.where(F.col("key").isNotNull()).distinct()
    listed = listed.where(F.col("key").isNotNull()).distinct()
    return universe.join(listed.withColumn("listed", F.lit(True)), "key", "full").select("key", F.coalesce("listed", F.lit(False)).alias("listed"))


class Cascade:
    """Exact membership of listed keys among the marked ones (``key, listed``, each key once)."""

    def __init__(self, marked: DataFrame):
        yes, no = marked.where("listed").select("key"), marked.where("NOT listed").select("key")
        self.levels: list[Level] = []
        encoded, other = yes, no
        while True:
            n, level = encoded.count(), len(self.levels)
            if level and not n:  # the last level took in nothing false
                break
            per, hashes = (LATER_BITS, LATER_HASHES) if level else (FIRST_BITS, FIRST_HASHES)
            self.levels.append(encode(encoded, level, 64 * max(1, -(-n * per // 64)), hashes))
            encoded, other = other.where(self.levels[-1].holds(F.col("key"), level)), encoded

    def listed(self, key: Column) -> Column:
        """True where ``key``, one of the universe, is listed: the first level without it tells."""
        n = len(self.levels)
        out = F.lit(n % 2 == 1)
        for level in reversed(range(n)):
            out = F.when(self.levels[level].holds(key, level), out).otherwise(F.lit(level % 2 == 1))
        return out


def hosts_with(words: list[str], universe: DataFrame) -> DataFrame:
    """Keys of the universe whose first label has one of ``words`` alone or between hyphens."""
    return universe.where(F.arrays_overlap(F.split(F.substring_index("key", ".", 1), "-"), F.array(*map(F.lit, words))))


def key_universe(pages: DataFrame, url: str = "url") -> DataFrame:
    """All hosts of the corpus and their parent domains, once each."""
    return pages.select(host(F.col(url)).alias("h")).distinct().select(F.explode(suffixes(F.col("h"))).alias("key")).distinct()


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts))


def parts_for(listed: int, unlisted: int, most_bits: int) -> int:
    """Into how many parts keys are split, so that no level of a part has many more than ``most_bits`` bits."""
    return max(1, math.ceil(max(FIRST_BITS * listed, LATER_BITS * FALSE_SHARE * unlisted) / most_bits))


def url_filter(
    pages: DataFrame, listed: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, words: list[str] = LISTED_WORDS, url: str = "url", most_bits: int = MOST_BITS
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    The longest fitting rule decides; where none fits, a url is blocked if its host or one of the
    host's parent domains is listed. ``listed`` has a column ``key``; without it the corpus's own
    hosts with one of ``words`` are listed. Null urls and urls without ``://`` have empty host and
    path and are allowed. Repeated rows stay, an empty table gives an empty result, columns of
    the input named like the new ones are replaced, and urls may have any length.
    """
    with scratch.scope() as leave:
        universe = scratch.keep(key_universe(pages, url))
        marked = scratch.keep(marked_keys(hosts_with(words, universe) if listed is None else listed.select("key"), universe))
        parts = parts_for(*marked.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first(), most_bits)
        hit = "docloom_listed"
        while hit in (c.lower() for c in pages.columns):
            hit += "_"
        judged = pages.withColumn(hit, F.lit(False))
        for i in range(parts):
            part = Cascade(marked.where(part_of(F.col("key"), parts) == i))
            passed = judged.withColumn(hit, F.col(hit) | F.exists(suffixes(host(F.col(url))), lambda key: (part_of(key, parts) == i) & part.listed(key) if parts > 1 else part.listed(key)))  # noqa: B023
            judged = passed if parts == 1 else scratch.keep(passed)
        if parts > 1:
            leave(judged)
    name, where = host(F.col(url)), path(F.col(url))
    text, verdict = rule_of(name, where, rules)
    by_list = F.when(F.col(hit), "block").otherwise("allow")
    new = {"host": name, "path": where, "rule": text, "verdict": F.coalesce(verdict, by_list)}
    return judged.withColumns(new).drop(hit)
