"""Operator 2: personal data by weak supervision. DataFrame functions only.

Spans come in two layers. *Base* spans are what four fixed patterns and their checks give; they always
stay. *Candidates* are looser forms (numbers without a plus, ``name (at) host``, cards with other
separators). Five labelers vote -1, 0 or 1 on every base span and candidate: two regexes (the strict
form, the usual shape), a gazetteer (top-level domains, issuer prefixes, calling codes, reserved address
blocks) and two that look at the context. Votes are counted by kind and pattern, which leaves at most
``4 * 3 ** 5`` rows however large the corpus is; expectation-maximisation over these estimates every
labeler's reliability. Its posteriors are the soft labels of a naive Bayes span classifier whose counts
are one aggregation over the corpus's spans. Candidates that the classifier accepts are added.

A text is cut at a pattern once, into gaps and matches, so its work grows with its length; texts are
never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch

# The contract's patterns. Possessive where nothing can be given back, so that long runs need no stack;
# a match begins where its run of characters does, or right behind the match before.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(BASE)
MARK = {"email": "@", "ip": ".", "card": "", "phone": "+"}
AT, DOT = r"(?:@|\x20?[(\[{]at[)\]}]\x20?)", r"(?:\.|\x20?[(\[{]dot[)\]}]\x20?)"
LOOSE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\[\.\][0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9][\x20().0-9-]{6,20}[0-9](?![0-9A-Za-z])",
}
LOOSE_GUARD = {"email": r"@|[(\[{]at[)\]}]", "ip": r"\[\.\]", "card": r"[0-9][0-9\x20.-]{11}", "phone": r"[0-9][0-9\x20().-]{7}"}

OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SHAPE = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})$",
    "phone": r"^(?:\+[1-9]|00[1-9]|\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$)",
}
GAZETTEER = {
    "email": (r"\.(?:com|org|net|edu|gov|info|biz|io|co|ai|eu|uk|us|de|fr|es|it|nl|be|ch|at|pl|pt|ru|br|in|cn|jp|au|ca|mx)$", r"^[^.]*$"),
    "ip": (r"^(?!)", r"^(?:0+|127|169\.254|192\.0\.2|198\.51\.100|203\.0\.113|22[4-9]|2[3-5][0-9])\."),
    "card": (r"^(?:4|5[1-5]|2[2-7]|3[4-8]|6011|64[4-9]|65|62|50|5[6-9])", r"^(?:[01]|9)"),
    "phone": (r"^(?:\+|00)(?:1|7|2[07]|3[0-4]|36|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])", r"^0000"),
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|server|client|login|addr(?:ess)?|adresse)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|tel[eé]fono|t[eé]l[eé]phone|ruf)\b",
}
AGAINST = r"(?i)(?:[0-9A-Za-z_#/=\"-]|\b(?:version|release|isbn|issn|doi|sha|hash|token|key|serial|order|invoice|no\.?|nr\.?|id)[\s:=#\"]*)$"
#: Spans a classifier step looks at: characters before and after, buckets of a hashed feature; a candidate needs this probability.
BEFORE, AFTER, BUCKETS, ACCEPT, BLOCK, ROUNDS = 32, 12, 512, 0.9, 512, 60
FEATURES = ("votes", "shape", "length", "word", "before", "after")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """The check-digit test over at most 19 digits."""
    padded, total = F.lpad(digits(m), 19, "0"), F.lit(0)
    for at in range(19):
        d = F.substring(padded, 19 - at, 1).cast("int")
        total = total + (d if at % 2 == 0 else d * 2 - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def valid(kind: str, m: Column) -> Column:
    """The check that a match of a base pattern has to pass."""
    n = F.length(digits(m))
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), luhn(m)).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


CUT = "array<struct<m:string,gap:string,after:string>>"
SPAN = "array<struct<start:int,stop:int,m:string,before:string,after:string>>"


def cut(text: Column, pattern: str, guard: Column) -> Column:
    """``[(m, gap, after)]``: the matches of a pattern, the text in front of each, the text behind it."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(found.alias("m"), F.slice(parts, F.lit(1), F.size(parts) - 1).alias("gap"), F.slice(parts, F.lit(2), F.size(parts)).alias("after"))
    return F.when(guard & text.rlike(pattern), rows.cast(CUT)).otherwise(F.array().cast(CUT))


def wide(x: Column) -> Column:
    return F.length(x["gap"]) + F.length(x["m"])


def sums(rows: Column) -> Column:
    """The characters of every ``BLOCK`` matches of a cut."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int")))
    return F.transform(starts, lambda b: F.aggregate(F.slice(rows, b * BLOCK + 1, BLOCK), F.lit(0), lambda s, x: s + wide(x)))


def placed(rows: Column, blocks: Column, keep: Callable[[Column], Column]) -> Column:
    """The places of the matches that ``keep`` accepts. Counted in blocks of ``BLOCK``, since an array grows by
    copying; ``rows`` and ``blocks`` (their ``sums``) have to be columns, as a lambda computes anew what it holds."""

    def block(b: Column) -> Column:
        begin = F.aggregate(F.slice(blocks, F.lit(1), b), F.lit(0), lambda s, x: s + x)

        def add(state: Column, x: Column) -> Column:
            at, stop = state["at"] + F.length(x["gap"]), state["at"] + wide(x)
            span = F.struct(at.alias("start"), stop.alias("stop"), x["m"].alias("m"), F.right(x["gap"], F.lit(BEFORE)).alias("before"), F.substring(x["after"], 1, AFTER).alias("after"))
            return F.struct(stop.alias("at"), F.when(keep(x["m"]), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

        return F.aggregate(F.slice(rows, b * BLOCK + 1, BLOCK), F.struct(begin.alias("at"), F.array().cast(SPAN).alias("out")), add, lambda s: s["out"])

    return F.when(F.size(rows) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.size(blocks) - 1), block))).otherwise(F.array().cast(SPAN))


def strict(kind: str, m: Column) -> Column:
    """Whether a candidate would be a base span but for its separators."""
    return m.rlike(rf"{DOT[:-1]})[A-Za-z0-9-]+$" if kind == "email" else r"^(?:00|\()" if kind == "phone" else ".")


def votes(kind: str, span: Column, base: bool) -> Column:
    """Five digits: 0 against, 1 abstains, 2 for; in the order strict, shape, gazetteer, context, context against."""
    m = F.trim(span["m"])
    for_it, against = GAZETTEER[kind]
    known = digits(m) if kind == "card" else m
    near = F.concat_ws(" ", span["before"], span["after"])
    return F.concat(
        F.lit("2") if base else F.when(strict(kind, span["m"]), "1").otherwise("0"),
        F.when(m.rlike(SHAPE[kind]), "2").otherwise("0"),
        F.when(known.rlike(against), "0").when(known.rlike(for_it), "2").otherwise("1"),
        F.when(near.rlike(CONTEXT[kind]), "2").otherwise("1"),
        F.when(span["before"].rlike(AGAINST) | span["after"].rlike(r"^[0-9A-Za-z_]"), "0").otherwise("1"),
    )


def bucket(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")


def described(kind: str, span: Column, base: bool) -> list[Column]:
    """The classifier's features of a span, each a bucket number."""
    shape = F.regexp_replace(F.regexp_replace(span["m"], "[0-9]", "9"), "[A-Za-z]+", "a")
    edge = lambda c: F.regexp_replace(F.regexp_replace(c, "[0-9]", "9"), r"\p{L}", "a")
    word = F.lower(F.regexp_extract(span["before"], r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$", 1))
    found = [votes(kind, span, base), shape, F.least(F.length(span["m"]), F.lit(63)), word, edge(F.right(span["before"], F.lit(1))), edge(F.substring(span["after"], 1, 1))]
    return [bucket(F.concat(F.lit(f"{kind} "), c.cast("string"))) for c in found]


@dataclass
class Model:
    """Reliabilities by kind, labeler and vote, as ``(if clean, if personal)``, and the classifier's weights."""

    prior: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, list[list[tuple[float, float]]]] = field(default_factory=dict)
    bias: dict[str, float] = field(default_factory=dict)
    weights: dict[str, list[list[float]]] = field(default_factory=dict)  # kind -> feature -> bucket

    def posterior(self, kind: str, vote: str) -> float:
        odds = math.log(self.prior[kind] / (1 - self.prior[kind]))
        for labeler, v in enumerate(vote):
            clean, personal = self.reliability[kind][labeler][int(v)]
            odds += math.log(personal / clean)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))

    def probability(self, kind: str, features: Column) -> Column:
        odds = F.lit(self.bias.get(kind, -100.0))
        for f, weight in enumerate(self.weights.get(kind, [])):
            odds = odds + F.get(F.lit(weight), F.get(features, F.lit(f)))
        return 1 / (1 + F.exp(-odds))

    def accepts(self, kind: str) -> Callable[[Column], Column]:
        return lambda span: self.probability(kind, F.array(*described(kind, span, False))) >= ACCEPT


def expectation_maximisation(counts: dict[tuple[str, str], int], rounds: int = ROUNDS) -> Model:
    """Labelers' reliabilities from the counts of vote patterns alone. A vote for may not speak against, nor
    the other way round, which keeps the two classes from changing places."""
    model = Model()
    for kind in {k for k, _ in counts}:
        own = {v: n for (k, v), n in counts.items() if k == kind}
        belief = {v: 1 / (1 + math.exp(-1.5 * (sum(map(int, v)) - len(v)))) for v in own}
        for _ in range(rounds):
            mass = [sum(n * (1 - belief[v]) for v, n in own.items()), sum(n * belief[v] for v, n in own.items())]
            model.prior[kind] = (mass[1] + 1) / (mass[0] + mass[1] + 2)
            table = []
            for labeler in range(5):
                shares = []
                for vote in "012":
                    both = [sum(n * (belief[v] if y else 1 - belief[v]) for v, n in own.items() if v[labeler] == vote) for y in (0, 1)]
                    clean, personal = ((b + 0.5) / (m + 1.5) for b, m in zip(both, mass, strict=True))
                    wrong = (vote == "2" and personal < clean) or (vote == "0" and personal > clean) or vote == "1"
                    shares.append((1.0, 1.0) if wrong else (clean, personal))
                table.append(shares)
            model.reliability[kind] = table
            belief = {v: model.posterior(kind, v) for v in own}
    return model


def worth(kind: str, m: Column) -> Column:
    """Whether a match of a loose pattern is a candidate."""
    n = F.length(digits(m))
    return F.when(n.between(13, 19), luhn(m)).otherwise(F.lit(False)) if kind == "card" else n.between(9, 15) if kind == "phone" else F.lit(True)


def guard(kind: str, loose: bool, text: Column) -> Column:
    """True for every text that can hold a match; cheaper than the pattern itself."""
    return text.rlike(LOOSE_GUARD[kind]) if loose else text.contains(MARK[kind])


def _with_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``docloom_<kind>_base`` and ``docloom_<kind>_loose``; candidates that touch a base span are left out."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    each = [(f"docloom_{kind}_{name}", kind, name == "loose") for kind in KINDS for name in ("base", "loose")]
    docs = docs.withColumns({name: cut(text, (LOOSE if loose else BASE)[kind], guard(kind, loose, text)) for name, kind, loose in each})
    docs = docs.withColumns({f"{name}_sums": sums(F.col(name)) for name, _, _ in each})

    def found(name: str, kind: str, loose: bool) -> Column:
        return placed(F.col(name), F.col(f"{name}_sums"), lambda m: (worth if loose else valid)(kind, m))

    docs = docs.withColumns({name: found(*x) for x in each for name in x[:1]}).drop(*[f"{name}_sums" for name, _, _ in each])
    docs = docs.withColumn("docloom_taken", F.concat(*[F.col(f"docloom_{kind}_base") for kind in KINDS]))
    free = lambda x: ~F.exists("docloom_taken", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"]))
    return docs.withColumns({f"docloom_{kind}_loose": F.filter(f"docloom_{kind}_loose", free) for kind in KINDS}).drop("docloom_taken")


def _told(spans: str, kind: str, base: bool) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), votes(kind, s, base).alias("votes"), F.array(*described(kind, s, base)).alias("features")))


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Learns from all spans of ``docs``. What comes to the driver is bounded: vote patterns and feature buckets."""
    rows = _with_spans(docs.select(F.col(text_col).alias("text")), "text")
    per_kind = []
    for kind in KINDS:
        for base, name in ((True, "base"), (False, "loose")):
            per_kind.append(_told(f"docloom_{kind}_{name}", kind, base))
    spans = scratch.keep(rows.select(F.explode(F.concat(*per_kind)).alias("s")).select("s.*"))
    counts = {(r.kind, r.votes): r.n for r in spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()}  # at most 4 * 3**5
    model = expectation_maximisation(counts)
    if not counts:
        return model
    belief = spans.sparkSession.createDataFrame([(k, v, model.posterior(k, v)) for k, v in counts], "kind string, votes string, p double")
    soft = spans.join(F.broadcast(belief), ["kind", "votes"]).select("kind", "p", F.posexplode("features").alias("f", "b"))
    sums = soft.groupBy("kind", "f", "b").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()  # at most 4 * 6 * BUCKETS
    for kind in {k for k, _ in counts}:
        own = [r for r in sums if r.kind == kind]
        yes, no = (sum(r[c] for r in own if r.f == 0) for c in ("yes", "no"))
        model.bias[kind] = math.log((yes + 1) / (no + 1))
        model.weights[kind] = [[0.0] * BUCKETS for _ in FEATURES]
        for r in own:
            model.weights[kind][r.f][r.b] = math.log((r.yes + 0.5) / (yes + 1)) - math.log((r.no + 0.5) / (no + 1))
    scratch.drop(spans)
    return model


def annotate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of ``(kind, start, stop)``, by kind in the order of ``KINDS``, then start.

    Places count code points, ``stop`` is exclusive. ``base`` are the fixed patterns' spans; ``spans`` are
    these and the candidates that the classifier accepts. A null or empty text has none. Rows are kept as
    they are, repeated ones and null ids too; an empty table gives an empty one; input columns named
    ``base`` or ``spans`` are replaced.
    """
    rows = _with_spans(docs.drop("base", "spans"), text_col)

    def plain(spans: Column | str, kind: str) -> Column:
        return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))

    base, both = [], []
    for kind in KINDS:
        accepted = F.filter(f"docloom_{kind}_loose", model.accepts(kind))
        base.append(plain(f"docloom_{kind}_base", kind))
        both.append(F.array_sort(F.concat(base[-1], plain(accepted, kind))))
    return rows.withColumns({"base": F.concat(*base), "spans": F.concat(*both)}).drop(*[f"docloom_{kind}_{n}" for kind in KINDS for n in ("base", "loose")])


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>``, ``<PHONE>``.

    One kind after the other; base spans first, then accepted candidates of what is left. A null text
    stays null and texts may have any length; repeated rows stay, an empty table gives an empty one, and further columns may have any name.
    """
    for loose in (False, True):
        for kind in KINDS:
            docs = _redact(docs, model, text_col, kind, loose)
    return docs


def _redact(docs: DataFrame, model: Model, text_col: str, kind: str, loose: bool) -> DataFrame:
    text, pattern = F.col(text_col), (LOOSE if loose else BASE)[kind]

    def personal(x: Column) -> Column:
        if not loose:
            return valid(kind, x["m"])
        span = F.struct(x["m"].alias("m"), F.right(x["gap"], F.lit(BEFORE)).alias("before"), F.substring(x["after"], 1, AFTER).alias("after"))
        return worth(kind, x["m"]) & model.accepts(kind)(span)

    docs = docs.withColumn("docloom_rows", cut(text, pattern, guard(kind, loose, text)))
    pieces = F.transform("docloom_rows", lambda x: F.concat(x["gap"], F.when(personal(x), f"<{kind.upper()}>").otherwise(x["m"])))
    tail = F.element_at("docloom_rows", -1)["after"]
    hit = F.exists("docloom_rows", personal)
    return docs.withColumn(text_col, F.when(hit, F.concat(F.array_join(pieces, ""), tail)).otherwise(text)).drop("docloom_rows")
