import random

from pyspark.sql import functions as F

from docloom.llm import line_dedup
from docloom.llm.line_dedup import line_groups
from tests.llm import helpers


def changed(rng, line, edits):
    for _ in range(edits):
        at = rng.randrange(len(line))
        line = line[:at] + rng.choice(["", "q", "q" + line[at]]) + line[at + 1 :]
    return line


def test_pairs_are_verified_exactly(spark):
    """What rules pairs out, or in by parts, before the whole lines are compared never differs from the edit distance, also with all edits at one place."""
    rng = random.Random(3)
    made = lambda n: "".join(rng.choice("abcdefgh") if i % 6 else " " for i in range(n)).strip()
    lines, pairs = [], []
    for n in [20, 29, 54, 110, 200, 330] * 8 + [1200, 1300, 1400]:
        a = made(n)
        most = len(a) // 10
        inserted = a[: n // 3] + "z" * rng.choice([most, most + 1]) + a[n // 3 :]
        for b in (changed(rng, a, rng.randint(most // 2, most + most // 2)), inserted, a[most:] + "y" * rng.choice([0, 1, 2]), "é" + a[:-1], made(n)):
            pairs.append((len(lines), len(lines) + 1))
            lines += [a, b]
    texts = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    found = {(r.a, r.b) for r in line_dedup._verified(spark.createDataFrame(pairs, "a long, b long"), texts, 0.9).collect()}
    assert found == {(a, b) for a, b in pairs if helpers.edit_distance(lines[a], lines[b]) <= int(max(len(lines[a]), len(lines[b])) * 0.1 + 1e-9)}


def test_common_keys_need_few_tables(spark, monkeypatch):
    """Lines under common keys are brought together once, not again for every width of joined keys."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7))
    passage = " ".join(word() for _ in range(30))
    docs = spark.createDataFrame([(i, passage + " " + " ".join(word() for _ in range(30))) for i in range(60)], "doc_id long, text string")
    lines = line_dedup.scratch.keep(line_dedup._lines(docs, "doc_id", "text", 1))
    kept, keep = [], line_dedup.scratch.keep
    monkeypatch.setattr(line_dedup.scratch, "keep", lambda df: kept.append(df.columns) or keep(df))
    assert line_groups(lines).count() == 0
    assert len(kept) <= 40


def test_keys_of_the_same_lines_are_one(spark, monkeypatch):
    """Lines that share a passage share many keys. These are kept and paired as one, and a pair under several keys is compared once."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7))
    passage = " ".join(word() for _ in range(60))
    docs = spark.createDataFrame([(i, f"{passage} {word()}") for i in range(40)], "doc_id long, text string")
    lines = line_dedup.scratch.keep(line_dedup._lines(docs, "doc_id", "text", 1))
    rows, keep = [], line_dedup.scratch.keep

    def counted(df):
        out = keep(df)
        if {"key", "h", "pivot"} <= set(out.columns):
            rows.append(out.count())
        return out

    monkeypatch.setattr(line_dedup.scratch, "keep", counted)
    groups = line_groups(lines)
    assert groups.count() == 40 and groups.select("component").distinct().count() == 1
    assert 0 < sum(rows) <= 40 * 20


def test_normalised_lines(spark):
    """Single spaces stay as they are; all other runs become one space, also at the ends and before line ends."""
    texts = ["a b", " a  b ", "a, b", "a ,b", "a\tb", "a \n b", "  \n", " \na", "É ß 東 京", "a - b -\n- c", " ", ""]
    wanted = ["a b", " a b ", "a b", "a b", "a b", "a \n b", " \n", " \na", "é ß 東 京", "a b \n c", " ", ""]
    found = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", line_dedup.normalised(F.col("text")).alias("x"))
    assert [r.x for r in found.orderBy("i").collect()] == wanted


def test_counts_of_characters_rule_out_pairs_before_they_are_made(spark, monkeypatch):
    """No pair of similar lines goes by its counts; of lines that share a passage only, few are paired."""
    rng = random.Random(5)
    made = lambda n, of: "".join(rng.choice(of) for _ in range(n)).strip() or "x"
    lines, wanted = [], []
    for n in (5, 30, 60, 200, 500, 1200):
        for of in ("abcdefgh ", "abcdefghijklmnopqrstuvwxyz 0", "eeeeeeet ", "東京äö zé", "zzz", "019 "):
            a = made(n, of)
            for b in (changed(rng, a, n // 10), a[n // 10 :] + "q" * rng.randrange(3), a + "e" * (n // 12), made(n, of), made(n, "xyz ")):
                lines.append((len(lines), a, b))
    rows = spark.createDataFrame(lines, "i long, a string, b string")
    both = [rows.select("i", F.length(k).alias("n"), *line_dedup._counts(F.col(k))).alias(s) for k, s in (("a", "p"), ("b", "q"))]
    most = F.lit(100_000)
    assert both[0].join(both[1], F.col("p.i") == F.col("q.i")).where(line_dedup._counts_near("p", "q", most)).count() == len(lines)
    for i, a, b in lines:
        exact = lambda x, y: sum(max(0, min(127, x.count(c)) - min(127, y.count(c))) for some in line_dedup.COUNTED for c in some)
        wanted.append((i, max(exact(a, b), exact(b, a))))
    least = spark.createDataFrame(wanted, "i long, least long")
    joined = both[0].join(both[1], F.col("p.i") == F.col("q.i")).join(least.alias("r"), F.col("r.i") == F.col("p.i"))
    assert joined.where(line_dedup._counts_near("p", "q", F.col("least"))).count() == len(lines)
    assert joined.where(line_dedup._counts_near("p", "q", F.col("least") - 1)).count() == 0

    passage = made(40, "abcdefghijklmnopqrstuvwxyz")
    docs = spark.createDataFrame([(i, f"{passage} {made(120, letters)}") for i, letters in enumerate(rng.sample("bcdfghjklmnpqrstvwxz", 8) for _ in range(40))], "doc_id long, text string")
    compared, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    assert line_groups(line_dedup.scratch.keep(line_dedup._lines(docs, "doc_id", "text", 1))).count() == 0
    assert sum(compared[1:]) < 100  # of 741 pairs without the pivot
