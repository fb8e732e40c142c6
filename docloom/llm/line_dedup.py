"""Operator 4: fuzzy line deduplication over a whole corpus. DataFrame functions only.

Lines are normalised (lower case, all but letters and digits to one space). Equal normalised lines are
one *line* from here on, named by two hashes. Similar lines meet under keys made of characters, and are
verified by edit similarity:

- Of two lines up to ``SHORT`` characters, the shorter is cut into one piece more than the edits allowed, so
  one piece stands whole in the longer, near its place (Li et al., Pass-Join, 2011). All such pairs meet.
- A longer line's keys are the ``SKETCH`` smallest hashes of its runs of ``GRAM`` characters: of all of them up to
  ``MIDDLE`` characters, beyond of those at the beginnings of words. Two lines that share a part j of these
  miss each other with a chance of ``(1 - j) ** SKETCH``. Lines over ``LONG`` characters have ``LONG_SKETCH`` keys and
  must share two of them, as comparing two long lines that share one common run by chance would take most of the time.

Under a key every line is compared with one pivot first, so a group of similar lines needs a comparison a line.
Then all pairs of lines under a key that are still in different groups, and whose lengths allow it, are compared as
well, so no list of lines is cut. Their number grows with the square of a key's lines; keys of over ``FEW`` lines are dealt out
by length, and those of over ``MANY`` also by ``SPREAD`` parts. Keys that the same lines share, as those of a common passage,
are one key of so much weight, and a pair is compared once. Before two lines are compared, the pieces of ``BLOCK``
characters that one is cut into are looked for in the other, near their places: an edit spoils one of them at most.

Of every connected group of lines one occurrence stays: the one of the smallest id, then the first in its text.
Lines with their texts, the different ones' texts, then their keys are written once; what follows reads columns of these tables. Pairs have no texts until
they are compared, and before they are made, counts of characters, which their lines carry, rule most of them out.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch
from docloom.llm.components import components

#: Lines of fewer words are never removed, unless the caller says otherwise.
LEAST_WORDS, SIMILARITY = 3, 0.9
SHORT, MIDDLE, LONG, GRAM, SKETCH, LONG_SKETCH, BLOCK, PART = 53, 110, 400, 14, 24, 32, 6, 256
#: Keys are counted and joined in so many passes, each of a part of them, which bounds the shuffle. Their bits: they only bring lines together.
PASSES, KEY_BITS = 4, 48
#: Lines of keys with more than ``FEW`` are compared in pairs by classes of length, of more than ``MANY`` by ``SPREAD`` parts as well.
FEW, MANY, SPREAD = 24, 512, 4
#: Of these characters a line's counts are kept, up to 127 of each (the sum of two fits a byte), seven in a number.
COUNTED = ["abcdefg", "hijklmn", "opqrstu", "vwxyz 0"]
COUNTS = [f"l{k}" for k in range(len(COUNTED))]
#: Pairs get their texts and are compared so many at once, which bounds the shuffle.
PAIRS = 1_000_000
#: A table is broadcast up to so many rows, of two numbers each or of as many list entries.
BROADCAST_ROWS = 400_000
NO_KEYS = "array<bigint>"


def normalised(text: Column) -> Column:
    """Lower case, all but letters and digits to one space; line ends stay. Single spaces aren't matched, as they stay too."""
    return F.regexp_replace(F.lower(text), r"(?! [\p{L}\p{N}])[^\p{L}\p{N}\n]+", " ")


def small(df: DataFrame, entries: Column | None = None, built: bool = False) -> DataFrame:
    """A written table to look rows up in: broadcast up to ``BROADCAST_ROWS`` rows and list ``entries``, else joined by a shuffle;
    ``built``: without sorting both sides, for tables of short rows with one row a key."""
    rows, listed = df.agg(F.count("*"), F.sum(F.lit(0) if entries is None else entries)).first()
    if max(rows, listed or 0) <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df.hint("shuffle_hash") if built else df


def _name(*columns: str | Column) -> list[Column]:
    """Two 64-bit hashes that together name a value."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("docloom"), *columns)]


def _lines(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``place, h, g, n, line``: every line with at least ``least`` words, ``n`` its length.

    ``place`` holds the id, the name of id and text, and the position. Texts are normalised before their
    lines are dealt out, so once.
    """
    doc, more = _name(id_col, text_col)
    named = docs.select(F.col(id_col).alias("id"), doc.alias("doc"), more.alias("more"), F.transform(F.split(normalised(F.col(text_col)), "\n"), lambda x: F.trim(x)).alias("lines"))
    lines = named.select("id", "doc", "more", F.posexplode_outer("lines").alias("pos", "line"))  # outer: else the texts are normalised again to filter them
    lines = lines.where("line != ''")
    if least > 1:
        lines = lines.where(F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1 >= least)
    h, g = _name("line")
    return lines.select(F.struct("id", "doc", "more", "pos").alias("place"), h.alias("h"), g.alias("g"), F.length("line").alias("n"), "line")


def _most(n: Column, similarity: float) -> Column:
    """The edits that two lines may differ in, the longer one of ``n`` characters."""
    # Round before flooring: 1 - 0.9 is a little under 0.1 in doubles.
    return F.floor(n * round(1 - similarity, 9)).cast("int")


def _close(a: Column, b: Column, similarity: float) -> Column:
    return F.abs(a - b) <= _most(F.greatest(a, b), similarity)


def _least_partner(size: int, similarity: float) -> int:
    """The length of the shortest line that may be similar to one of more than ``size`` characters."""
    return size + 1 - int((size + 1) * round(1 - similarity, 9))


def _pieces(line: Column, n: Column, similarity: float) -> Column:
    """Keys of a line of up to ``SHORT`` characters: its own pieces, for every number of edits that a longer line may allow,
    and its substrings that may be pieces of a shorter or equally long line."""

    def start(i: Column, size: Column, d: Column) -> Column:
        return F.floor(i * size / (d + 1)).cast("int")

    def key(i: Column, size: Column, d: Column, at: Column) -> Column:
        return F.xxhash64(size, d, i, F.substring(line, at + 1, start(i + 1, size, d) - start(i, size, d)))

    def own(d: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), d), lambda i: key(i, n, d, start(i, n, d)))

    def of_shorter(size: Column, d: Column) -> Column:
        def places(i: Column) -> Column:
            low = F.greatest(F.lit(0), start(i, size, d) + F.greatest(-i, n - size - d + i))
            high = F.least(n - start(i + 1, size, d) + start(i, size, d), start(i, size, d) + F.least(i, n - size + d - i))
            return F.when(low <= high, F.transform(F.sequence(low, high), lambda at: key(i, size, d, at))).otherwise(F.array().cast("array<bigint>"))

        return F.flatten(F.transform(F.sequence(F.lit(0), d), places))

    longer = F.filter(F.sequence(n, F.lit(SHORT)), lambda size: size - _most(size, similarity) <= n)
    edits = F.filter(F.array_distinct(F.transform(longer, lambda size: _most(size, similarity))), lambda d: d > 0)
    d = _most(n, similarity)
    probes = F.flatten(F.transform(F.sequence(n - d, n), lambda size: of_shorter(size, d)))
    return F.array_distinct(F.concat(F.flatten(F.transform(edits, own)), F.when(d > 0, probes).otherwise(F.array().cast("array<bigint>"))))


def _smallest(runs: Column, size: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(F.transform(runs, lambda run: F.shiftrightunsigned(F.xxhash64(run), 64 - KEY_BITS)))), F.lit(1), size)


def _counts(line: Column) -> list[Column]:
    """How often the ``COUNTED`` characters stand in a line, then the sum of these numbers."""
    left = lambda c: F.octet_length(F.replace(line, F.lit(c), F.lit("")))
    each = [[F.least(F.octet_length(line) - left(c), F.lit(127)).cast("long") for c in some] for some in COUNTED]
    packed = [reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(n, 8 * k) for k, n in enumerate(some)]) for some in each]
    return [*(x.alias(name) for x, name in zip(packed, COUNTS, strict=True)), reduce(lambda x, y: x + y, sum(each, [])).cast("int").alias("counted")]


def _counts_near(p: str, q: str, most: Column) -> Column:
    """Whether so few edits may lead from one line's counts to the other's: an edit takes one character away at most, and adds one at most.

    All seven counts of a number are compared at once, each in a byte of which the highest bit tells which one is larger. Columns
    are computed as often as they are written here, as Spark takes these conditions into the join.
    """
    highest = F.lit(sum(128 << 8 * k for k in range(7)))

    def more(name: str) -> Column:
        apart = F.col(f"{p}.{name}").bitwiseOR(highest) - F.col(f"{q}.{name}")
        return apart.bitwiseAND(F.shiftright(apart.bitwiseAND(highest), 7) * 127)

    def halves(some: Column) -> Column:
        return some.bitwiseAND(F.lit(0x00FF00FF00FF00FF)) + F.shiftright(some, 8).bitwiseAND(F.lit(0x00FF00FF00FF00FF))

    gone = halves(more(COUNTS[0]) + more(COUNTS[1])) + halves(more(COUNTS[2]) + more(COUNTS[3]))
    # The rest of a division by 65,535 is the sum of the 16-bit parts. What is added is what is gone less the difference of all.
    return gone % 65535 <= most + F.least(F.col(f"{p}.counted") - F.col(f"{q}.counted"), F.lit(0))


def _keys(line: Column, n: Column, similarity: float) -> Column:
    """The keys of one line. Two similar lines share a kind of key: the bounds of the kinds overlap by what lengths may differ."""
    none, least = F.array().cast(NO_KEYS), lambda size: _least_partner(size, similarity)
    every = F.regexp_extract_all(line, F.lit(rf"(?=(.{{{GRAM}}}))"), F.lit(1))
    # Scripts without spaces have no beginnings of words: all runs there, and in lines of very long words.
    spaces = n - F.length(F.replace(line, F.lit(" "), F.lit("")))
    begun = F.when(n > 12 * (spaces + 1), every).otherwise(F.regexp_extract_all(line, F.lit(rf"(?:^| )(?=(.{{{GRAM}}}))"), F.lit(1)))
    pieces = F.when(n <= SHORT, _pieces(line, n, similarity)).otherwise(none)
    middle = F.when((n >= least(SHORT)) & (n <= MIDDLE), _smallest(every, F.lit(SKETCH))).otherwise(none)
    long = F.when(n >= least(MIDDLE), _smallest(begun, F.when(n >= least(LONG), LONG_SKETCH).otherwise(SKETCH))).otherwise(none)
    return F.when(n <= least(SHORT) - 1, pieces).when((n > SHORT) & (n < least(MIDDLE)), middle).when(n > MIDDLE, long).otherwise(F.concat(pieces, middle, long))


def _blocks_left(one: str, two: str, apart: str, most: str) -> Column:
    """Whether so few edits may lead from one line to the other: all but ``most`` pieces of the first stand in the second, longer by ``apart``.

    A piece moves by what is inserted less what is deleted before it, and what is behind it has to make up for that:
    its place is within half of ``most`` about half of ``apart``. All four are columns, not expressions, as they are read for each piece.
    """
    near = lambda i: F.substring(two, F.greatest(i * BLOCK + F.shiftright(F.col(apart) - F.col(most), 1) + 1, F.lit(1)), F.col(most) + BLOCK + 1)
    pieces = F.regexp_extract_all(F.col(one), F.lit(f".{{{BLOCK}}}"), F.lit(0))
    return F.size(F.filter(pieces, lambda x, i: F.contains(near(i), x))) >= F.floor(F.length(one) / BLOCK) - F.col(most)


def _close_by_parts(a: Column, b: Column, most: Column) -> Column:
    """Whether lines cut at the same places need so few edits part by part, which are enough for the whole."""
    parts = lambda x: F.regexp_extract_all(x, F.lit(f".{{1,{PART}}}"), F.lit(0))
    edits = F.zip_with(parts(a), parts(b), lambda x, y: F.call_function("levenshtein", F.coalesce(x, F.lit("")), F.coalesce(y, F.lit("")), F.lit(PART // 8)))
    return F.forall(edits, lambda x: x >= 0) & (F.aggregate(edits, F.lit(0), lambda total, x: total + x) <= most)


def _shared_beginning(a: Column, b: Column) -> Column:
    """How many first characters two texts share, found by halving."""
    steps = F.filter(F.array(*(F.lit(1 << k) for k in range(20, -1, -1))), lambda step: step <= F.least(F.length(a), F.length(b)))
    return F.aggregate(steps, F.lit(0), lambda known, step: F.when((known + step <= F.least(F.length(a), F.length(b))) & (F.substring(a, known + 1, step) == F.substring(b, known + 1, step)), known + step).otherwise(known))


def _once(df: DataFrame) -> DataFrame:
    """``df``, its columns computed once a row: Spark puts expressions in place of columns, also within functions of list entries."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("row")).select("row.*")


def _texts(lines: DataFrame) -> DataFrame:
    """``h, g, n, line`` of the different lines. Rows of one h are equal lines, but for clashes of hashes: then the one of the smallest g is taken."""
    return lines.groupBy("h").agg(F.min(F.struct("g", "line")).alias("x")).select("h", "x.g", F.length("x.line").alias("n"), "x.line")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of ``pairs`` (``a, b``) those whose edit distance is at most ``1 - similarity`` of the longer one.

    Only what lies between the first and the last difference is compared: the comparison takes the square of its length.
    """
    for k in "ab":
        pairs = pairs.join(texts.select(F.col("h").alias(k), F.col("line").alias(f"{k}_line"), F.length("line").alias(f"{k}_n")), k)
    pairs = _once(pairs.select("a", "b", _most(F.greatest("a_n", "b_n"), similarity).alias("most"), (F.col("b_n") - F.col("a_n")).alias("apart"), "a_line", "b_line"))
    pairs = pairs.where(F.abs("apart") <= F.col("most")).where(_blocks_left("a_line", "b_line", "apart", "most")).select("a", "b", "most", "a_line", "b_line")
    for _ in range(2):  # the beginning, then the end of what is left, turned around
        pairs = _once(pairs.select("a", "b", "most", "a_line", "b_line", _shared_beginning(F.col("a_line"), F.col("b_line")).alias("same")))
        pairs = _once(pairs.select("a", "b", "most", *(F.reverse(F.substring(f"{k}_line", F.col("same") + 1, F.length(f"{k}_line"))).alias(f"{k}_line") for k in "ab")))
    # A comparison's time grows with the square of the length, so long lines are tried by parts first.
    by_parts = (F.length("a_line") > 4 * PART) & _close_by_parts(F.col("a_line"), F.col("b_line"), F.col("most"))
    whole = F.call_function("levenshtein", "a_line", "b_line", F.col("most")) >= 0
    return pairs.where(F.when(by_parts, True).otherwise(whole)).select("a", "b")


def _met(keyed: DataFrame) -> DataFrame:
    """``key, pivot, last, m, who`` of the keys that different lines share: the lines of the smallest and the largest hash, their number and a hash of all."""
    return keyed.groupBy("key").agg(F.min("h").alias("pivot"), F.max("h").alias("last"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("h")).alias("who")).where("m > 1")


def _pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """``a, b, n, w, starred``: pairs of ``rows`` (``key, h, n, c, m, pivot, w`` and counts) under one key, in different groups, whose lengths
    and counts of characters may belong to similar lines; ``n`` of the longer one, ``starred`` if one is the key's pivot."""
    # Lengths that may differ by the edits allowed lie in one class or in neighbouring ones.
    step = max(-math.log(similarity), 1e-6) * (1 + 1e-9)
    size, parts = F.floor(F.log("n") / F.lit(step)), F.when(F.col("m") > MANY, SPREAD).otherwise(1)
    own = lambda size, part: ["key", "h", "n", "c", "pivot", "w", *COUNTS, "counted", size.alias("size"), part.alias("part")]
    p = rows.select(*own(F.when(F.col("m") > FEW, size).otherwise(0), F.pmod(F.xxhash64("h"), parts).cast("int"))).alias("p")
    near = F.when(F.col("m") > FEW, F.array(size, size + 1)).otherwise(F.array(F.lit(0).cast("long")))
    q = rows.withColumn("near", F.explode(near)).withColumn("slot", F.explode(F.sequence(F.lit(0), parts - 1)))
    q = q.select(*own(F.col("near"), F.col("slot"))).alias("q")
    # q is the shorter one, or of two equally long ones that of the smaller hash.
    shorter = (F.col("q.n") < F.col("p.n")) | ((F.col("q.n") == F.col("p.n")) & (F.col("q.h") < F.col("p.h")))
    meet = (F.col("p.key") == F.col("q.key")) & (F.col("p.size") == F.col("q.size")) & (F.col("p.part") == F.col("q.part")) & shorter
    pairs = p.join(q, meet & (F.col("p.c") != F.col("q.c")) & (F.col("p.n") - F.col("q.n") <= _most(F.col("p.n"), similarity)) & _counts_near("p", "q", _most(F.col("p.n"), similarity)))
    starred = (F.col("p.h") == F.col("p.pivot")) | (F.col("q.h") == F.col("q.pivot"))
    return pairs.select(F.least("p.h", "q.h").alias("a"), F.greatest("p.h", "q.h").alias("b"), "p.n", "p.w", starred.alias("starred"))


def line_groups(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``h, g, component``: the connected groups of different lines that are similar."""
    with scratch.scope() as leave:
        return leave(_groups(scratch.keep(_texts(lines)), similarity))


def _compared(pairs: DataFrame, texts: DataFrame, similarity: float) -> list[DataFrame]:
    """The written pairs of similar lines, ``PAIRS`` at once. Only the texts of lines in pairs are shuffled."""
    passes = 1 + pairs.count() // PAIRS
    used = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    texts = scratch.keep(texts.join(small(scratch.keep(used), built=True), "h", "left_semi").select("h", "line"))
    found = [scratch.keep(_verified(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(passes)) == i), texts, similarity)) for i in range(passes)]
    scratch.drop(texts)
    return found


def _groups(texts: DataFrame, similarity: float) -> DataFrame:
    with scratch.scope() as leave:
        sketches = scratch.keep(texts.select("h", "n", *_counts(F.col("line")), _keys(F.col("line"), F.col("n"), similarity).alias("keys")))
        keyed = sketches.select("h", "n", *COUNTS, "counted", F.explode("keys").alias("key"))
        passes = [keyed.where(F.pmod("key", F.lit(PASSES)) == i) for i in range(PASSES)]
        met = [scratch.keep(_met(some)) for some in passes]
        # Keys of the same lines are one key of so much weight; that of two lines is a pair.
        once = reduce(DataFrame.union, met).groupBy("pivot", "last", "m", "who").agg(F.min("key").alias("key"), F.count("*").alias("w"))
        once = scratch.keep(once)
        two, more = once.where("m = 2").select(F.col("pivot").alias("a"), F.col("last").alias("b"), "w"), scratch.keep(once.where("m > 2").select("key", "pivot", "m", "w"))
        own = [scratch.keep(some.join(small(more.where(F.pmod("key", F.lit(PASSES)) == i), built=True), "key").select("key", "h", "n", *COUNTS, "counted", "pivot", "m", "w")) for i, some in enumerate(passes)]
        for table in (sketches, more, *met):
            scratch.drop(table)
        tables, own = [once, *own], reduce(DataFrame.union, own)
        star = two.union(own.where("h <> pivot").select("pivot", "h", "w")).groupBy("a", "b").agg(F.sum("w").alias("w"))
        for k in "ab":
            star = star.join(small(texts.select(F.col("h").alias(k), F.col("n").alias(f"{k}_n")), built=True), k)
        star = scratch.keep(star.where(_close(F.col("a_n"), F.col("b_n"), similarity)).select("a", "b", F.greatest("a_n", "b_n").alias("n"), "w"))
        # Under how many keys a long line meets its pivot is a part of the keys that they share; all of them are counted below.
        tried = star.where(f"n <= {LONG} OR w > 1").select("a", "b")
        links = scratch.keep(_verified(tried, texts, similarity))
        # Lines of one group needn't be compared again.
        groups = scratch.keep(components(links).select(F.col("node").alias("h"), F.col("component").alias("c")))
        named = scratch.keep(own.join(small(groups, built=True), "h", "left").withColumn("c", F.coalesce("c", "h")))
        for table in tables:
            scratch.drop(table)
        mixed = scratch.keep(named.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("key"))
        pairs = _pairs(named.join(small(mixed, built=True), "key", "left_semi"), similarity)
        pairs = pairs.where(f"n > {LONG} OR NOT starred").select("a", "b", "n", "w").union(star.where(f"n > {LONG} AND w = 1"))
        pairs = pairs.groupBy("a", "b").agg(F.max("n").alias("n"), F.sum("w").alias("w")).where(f"n <= {LONG} OR w > 1")
        pairs = scratch.keep(pairs.select("a", "b").join(tried, ["a", "b"], "left_anti"))
        scratch.drop(named)
        groups = components(reduce(DataFrame.union, _compared(pairs, texts, similarity), links))
        names = texts.select("h", "g")
        return leave(scratch.keep(groups.join(names, F.col("node") == F.col("h")).select("h", "g", "component")))


def _fresh(name: str, taken: list[str]) -> str:
    """A column name that isn't taken."""
    while name.lower() in (x.lower() for x in taken):
        name += "_"
    return name


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated lines of their texts taken out, and ``n_lines``, ``n_removed``.

    Lines end at ``\\n``. Of every group of equal or similar lines one occurrence in the corpus stays;
    lines of fewer than ``least_words`` words all stay (1 takes every line that isn't empty). Rows are kept, also those left without a line;
    a null text stays null with 0 lines, an empty one has one empty line. Rows repeated exactly count as
    one document and come out alike. A null id sorts first. An empty table gives an empty one. Input
    columns named ``n_lines`` or ``n_removed`` are replaced; other columns may have any name.
    """
    docs = docs.drop("n_lines", "n_removed")
    with scratch.scope() as leave:
        whole = scratch.keep(_lines(docs, id_col, text_col, least_words))
        texts, lines = scratch.keep(_texts(whole)), scratch.keep(whole.select("h", "g", "place"))
        scratch.drop(whole)
        groups = _groups(texts, similarity)
        scratch.drop(texts)
        # Lines that occur again, and lines with a similar one, which may occur once each: their first places are wanted.
        firsts = lines.groupBy("h", "g").agg(F.min("place").alias("first"), F.count("*").alias("n"))
        known = firsts.join(groups, ["h", "g"], "left").where("n > 1 OR component IS NOT NULL").select("h", "g", "first", F.coalesce("component", "h").alias("c"), F.coalesce(F.lit(0).cast("long") * F.col("component"), "g").alias("d"))
        known = scratch.keep(known)
        table = scratch.keep(known.join(known.groupBy("c", "d").agg(F.min("first").alias("keep")), ["c", "d"]).select("h", "g", "keep"))
        gone = lines.select("h", "g", "place").join(small(table), ["h", "g"]).where("place <> keep")
        gone = leave(scratch.keep(gone.groupBy("place.doc", "place.more").agg(F.collect_set("place.pos").alias("gone"))))
        a, b, c = (_fresh(f"docloom_{x}", docs.columns) for x in ("doc", "more", "gone"))
        doc, more = _name(id_col, text_col)
        joined = docs.withColumns({a: doc, b: more}).join(small(gone.toDF(a, b, c), F.size(c)), [a, b], "left")
        split = F.split(text_col, "\n")
        left = F.filter(split, lambda _, i: ~F.array_contains(c, i))
        none = F.lit(0).cast("long")
        return joined.select(
            *(F.when(F.col(c).isNull(), F.col(x)).otherwise(F.array_join(left, "\n")).alias(x) if x == text_col else F.col(x) for x in docs.columns),
            F.when(F.col(text_col).isNull(), none).otherwise(F.size(split).cast("long")).alias("n_lines"),
            F.when(F.col(c).isNull(), none).otherwise(F.size(c).cast("long")).alias("n_removed"),
        )
