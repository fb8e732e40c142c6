import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from docloom.llm import turns as T
from docloom.llm.queries import damaged, op11_conversations

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """The first fault of each (role, text) in order."""
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, letters, repaired turns) by trying every letter at every place: a search over all edits, cheapest first."""
    import heapq

    marks, done = faults(rows), set()
    heap = [(0, "", 0, "", ())]  # cost, letters, turns read, initials, repaired
    while heap:
        cost, letters, i, initials, kept = heapq.heappop(heap)
        last = initials[-1:]
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, letters, list(kept)
        if (i, last) in done:
            continue
        done.add((i, last))
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for role in ("user", "assistant"):
            if role[0] in nexts:
                heapq.heappush(heap, (cost + 3, letters + "I", i, initials + role[0], (*kept, (role, ""))))
        if i == len(rows):
            continue
        (role, text), mark = rows[i], marks[i]
        heapq.heappush(heap, (cost + 4, letters + "D", i + 1, initials, kept))
        if mark in ("blank", "duplicate"):
            continue
        more = 3 if mark else 0
        if role[:1] and role[0] in nexts:
            heapq.heappush(heap, (cost + more, letters + "K", i + 1, initials + role[0], (*kept, (role, text))))
        for new in ("user", "assistant"):
            if new[0] in nexts:
                heapq.heappush(heap, (cost + 3 + more, letters + "R", i + 1, initials + new[0], (*kept, (new, text))))


def expected(rows):
    """Rows after damage, of one conversation: (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    told, numbers = [(r, t) for _, r, t in rows], {n for n, _, _ in rows if n is not None}
    marks = faults(told)
    cost, letters, kept = cheapest(told)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(told))
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return (gaps, *(marks.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def made(seed, conversations, longest):
    r, out = random.Random(seed), []
    for conv in range(conversations):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["A.", "B!", "C?", "cut", "", " \n", None, "end. \t", "x" * 3000 + ".", "é.\n", "D."])
            out.append((conv, r.choice([turn, turn, turn + 2, None]), role, text))
    return out


def told(rows, frame):
    found = {x[0]: tuple(x)[1:] for x in frame.collect()}
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = {c: expected([]) for c in {r[0] for r in rows}}
    for conv, group in itertools.groupby(sorted(damage(rows), key=lambda x: (x[0] is not None, x[0] or 0)), key=lambda x: x[0]):
        want[conv] = expected([x[1:] for x in group])
    assert found == want


@pytest.mark.parametrize("block", [1, 3, T.BLOCK])
def test_equals_the_search_over_all_edits(spark, block):
    rows = made(block, 250, 14) + [(None, 1, "user", "Null conversation."), (None, None, "assistant", "x"), (7, 7, "user", "A."), (7, 7, "user", "A.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    told(rows, T.report(T.repair(damaged(df), F.col("copies"), block)))


def test_the_given_table(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    told(rows, op11_conversations(spark, folder))


def test_one_conversation_in_many_partitions(spark):
    """A conversation of most rows is walked in blocks; its edits join up at their ends."""
    r = random.Random(3)
    rows = [(1, k, r.choice(["user", "assistant", "tool"]), r.choice([f"{k}.", f"{k}", "same.", ""])) for k in range(1500)] + [(2, 0, "user", "Hi.")]
    edits = T.repair(spark.createDataFrame(rows, SCHEMA).repartition(7), block=50)
    found = {x.conv_id: x for x in T.report(edits).collect()}
    want = expected([x[1:] for x in rows[:-1]])
    assert tuple(found[1])[1:] == want and found[2].audit == "KI" and found[2].cost == 3


def test_repaired_turns(spark):
    rows = [(5, 0, "system", "Rules."), (5, 1, "assistant", "Hello."), (5, 2, "user", "Why"), (5, 2, "user", "Why")]
    out = T.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(x.edit, x.role, x.text, x.fault, x.cost) for x in out] == [
        ("K", "system", "Rules.", "", 0), ("I", "user", "", None, 3), ("K", "assistant", "Hello.", "", 0), ("D", None, None, "truncated", 4), ("D", None, None, "duplicate", 4),
    ]


def test_empty_table_extra_columns_and_long_texts(spark):
    assert T.report(T.repair(spark.createDataFrame([], SCHEMA))).collect() == []
    rows = [(1, 0, "user", "a" * 2_000_000 + "?", 1, "x"), (1, 1, "assistant", "b" * 1_000_000, 2, "y")]
    df = spark.createDataFrame(rows, SCHEMA + ", copies int, codes string").withColumn("name", F.lit(1)).withColumn("block", F.lit(2))
    x = T.report(T.repair(df)).first()
    assert (x.audit, x.cost, x.truncated) == ("KK", 3, 1)
