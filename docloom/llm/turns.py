"""Conversation structure repair: the cheapest edits that give every conversation the form ``(s?(ua)+)?`` of roles.

A conversation is a graph: a node is a place between turns and a state of the form, an arc an edit of the next turn
(delete, keep, rerole) or an insertion before it. Forward and backward minimum costs tell which arcs lie on a
cheapest path; from the first node on, the least edit letter among the tight arcs of the frontier is taken.

Turns are numbered by a range partitioning, so a conversation may lie in many partitions: each block of at most
``BLOCK`` turns is a 4 x 4 matrix of costs, a scan over a conversation's matrices gives the costs at the blocks' ends,
and each block is then walked alone. Texts are shuffled once, for the edited turns.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch

BLOCK = 4096
#: States: nothing yet, behind a system turn, behind a user turn, behind an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind an inserted or reroled turn: the form leaves one choice.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: By a turn's initial: the state behind it for each state before, where it may be kept.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {}}
INITIALS = ["s", "u", "a", ""]
FAULTS = ["", "blank", "duplicate", "truncated"]
DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3
FAR = 1 << 40
#: Dearer by more than this than another state at the same place, a state lies on no cheapest path: any state reaches
#: what another one can reach for at most two insertions and a deletion more.
SPAN = 16
#: Costs to the end of a conversation behind its last turn.
AT_END = (0, 2 * INSERT, INSERT, 0)
SPACE = " \t\n\x0b\x0c\r"

Costs = tuple[int, int, int, int]


@cache
def _arcs(code: int) -> list[tuple[str, int, int, int]]:
    """Edits of a turn: letter, state before, state behind, cost."""
    fault, out = FAULTS[code >> 2], [("D", s, s, DELETE) for s in range(4)]
    if fault in ("blank", "duplicate"):
        return out
    more = CUT if fault == "truncated" else 0
    out += [("K", s, t, more) for s, t in KEPT[INITIALS[code & 3]].items()]
    return out + [("R", s, NEXT[s], REROLE + more) for s in range(4)]


def _least(costs: list[int]) -> tuple[Costs, int]:
    low = min(costs)
    return tuple(c - low if c - low <= SPAN else FAR for c in costs), low


@cache
def _settled(costs: Costs) -> Costs:
    """Costs at a place once turns were inserted there."""
    out = list(costs)
    for _ in range(2):
        for s in range(4):
            out[NEXT[s]] = min(out[NEXT[s]], out[s] + INSERT)
    return tuple(out)


@cache
def _forward(costs: Costs, code: int) -> tuple[Costs, int]:
    """Costs behind a turn (less their least, and the least) from those before it."""
    at, out = _settled(costs), [FAR] * 4
    for _, s, t, c in _arcs(code):
        out[t] = min(out[t], at[s] + c)
    return _least(out)


@cache
def _backward(costs: Costs, code: int) -> tuple[Costs, int]:
    """Costs to the end from before a turn, insertions there included, from those behind it."""
    out = [FAR] * 4
    for _, s, t, c in _arcs(code):
        out[s] = min(out[s], costs[t] + c)
    for _ in range(2):
        for s in range(4):
            out[s] = min(out[s], out[NEXT[s]] + INSERT)
    return _least(out)


@cache
def _step(ahead: Costs, code: int, behind: Costs, slack: int, state: int) -> tuple[str, int]:
    """The letters that consume a turn from a tight node, and the state behind it.

    ``slack``: the cheapest cost less what both cost vectors leave out. The letters decide the states, so a
    frontier that began with one node keeps one state.
    """
    at, (rest, low) = _settled(ahead), _backward(behind, code)
    letters, frontier = "", {state}
    while True:
        tight = [("I", NEXT[s]) for s in frontier if at[s] + INSERT + rest[NEXT[s]] + low == slack]
        tight += [(letter, t) for letter, s, t, c in _arcs(code) if s in frontier and at[s] + c + behind[t] == slack]
        least = min(letter for letter, _ in tight)
        letters, frontier = letters + least, {t for letter, t in tight if letter == least}
        if least != "I":
            return letters, min(frontier)


def _unit(state: int) -> Costs:
    return tuple(0 if s == state else FAR for s in range(4))


def matrix(codes: bytes) -> list[int]:
    """Costs from every state before the turns to every state behind them, row by row."""
    out = []
    for s in range(4):
        costs, total = _unit(s), 0
        for code in codes:
            costs, low = _forward(costs, code)
            total += low
        out += [c + total if c < FAR else FAR for c in costs]
    return out


def ends(matrices: list[list[int]]) -> tuple[list[list[int]], list[list[int]], int]:
    """For a conversation's blocks in order: costs before each, costs to the end behind each, and the cheapest cost."""
    before, behind = [list(_unit(START))], [list(AT_END)]
    for m in matrices[:-1]:
        before.append([min(min(before[-1][s] + m[4 * s + t] for s in range(4)), FAR) for t in range(4)])
    for m in reversed(matrices):
        behind.append([min(min(m[4 * s + t] + behind[-1][t] for t in range(4)), FAR) for s in range(4)])
    return before, behind[-2::-1], behind[-1][START]


def walk(codes: bytes, before: list[int], behind: list[int], cheapest: int, last: bool) -> tuple[list[int], list[str | None]]:
    """For each state before the block: the state behind it and the letters between; no letters where it isn't tight."""
    ahead, back = [_least(before)], [_least(behind)]
    for code in codes:
        costs, low = _forward(ahead[-1][0], code)
        ahead.append((costs, ahead[-1][1] + low))
    for code in reversed(codes):
        costs, low = _backward(back[-1][0], code)
        back.append((costs, back[-1][1] + low))
    back.reverse()
    states, letters = [-1] * 4, [None] * 4
    for entry in range(4):
        if before[entry] + back[0][0][entry] + back[0][1] != cheapest:
            continue
        state, found = entry, []
        for i, code in enumerate(codes):
            more, state = _step(ahead[i][0], code, back[i + 1][0], cheapest - ahead[i][1] - back[i + 1][1], state)
            found.append(more)
        while last and state in (SYSTEM, USER):
            state = NEXT[state]
            found.append("I")
        states[entry], letters[entry] = state, "".join(found)
    return states, letters


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _blocks(most: int):
    """Sorted turns of a partition as blocks of one conversation each, with their codes and matrix."""
    names = ["conv_id", "turn", "role", "name", "block", "codes", "matrix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, codes, out = TaskContext.get().partitionId() << 32, (), bytearray(), []
        for batch in batches:
            kinds = [c.type for c in batch.columns[:4]] + [pa.int64(), pa.binary(), pa.list_(pa.int64())]
            for conv, turn, role, name, code, repeat in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blank = FAULTS[code >> 2] == "blank"
                for k in range(repeat):
                    if not codes or first[0] != conv or len(codes) >= most:
                        if codes:
                            out.append((*first, number, bytes(codes), matrix(codes)))
                            number += 1
                        first, codes = (conv, turn, role, name), bytearray()
                    codes.append(code if k == 0 or blank else _code(code, "duplicate"))
            if len(out) >= 1000:
                yield _batch(out, names, kinds)
                out = []
        if codes:
            yield _batch([*out, (*first, number, bytes(codes), matrix(codes))], names, kinds)

    return run


def _code(code: int, fault: str) -> int:
    return code & 3 | FAULTS.index(fault) << 2


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matrices sorted by conversation and block; what is held is a conversation's matrices, one for ``BLOCK`` turns."""
    names, kinds = ["block", "before", "behind", "cheapest", "last"], [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.bool_()]
    conv, blocks, found, out = None, [], [], []

    def close() -> None:
        if blocks:
            before, behind, cheapest = ends(found)
            out.extend((b, x, y, cheapest, b == blocks[-1]) for b, x, y in zip(blocks, before, behind, strict=True))

    for batch in batches:
        for now, block, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not blocks or now != conv:
                close()
                conv, blocks, found = now, [], []
            blocks.append(block)
            found.append(m)
        if len(out) >= 5000:
            yield _batch(out, names, kinds)
            out.clear()
    close()
    if out:
        yield _batch(out, names, kinds)


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [walk(*x) for x in zip(*(batch.column(n).to_pylist() for n in ("codes", "before", "behind", "cheapest", "last")), strict=True)]
        keys = [batch.column(n) for n in ("conv_id", "turn", "role", "name", "block", "codes")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array([s for s, _ in found], pa.list_(pa.int32())), pa.array([x for _, x in found], pa.list_(pa.string()))], ["conv_id", "turn", "role", "name", "block", "codes", "states", "letters"])


EDITS = "turn {turn}, was_role string, fault string, edit string, cost int, role string, text string"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walked blocks and turns, sorted alike, as edits in order. A conversation without turns gives one row without an edit."""
    names = ["conv_id", "turn", "was_role", "fault", "edit", "cost", "role", "text"]
    conv, begun, empty, state, todo, out, size = None, False, True, START, deque(), [], 0

    def insertions() -> None:
        nonlocal state
        while todo and todo[0][0] == "I":
            todo.popleft()
            state = NEXT[state]
            out.append((conv, None, None, None, "I", INSERT, ROLES[state], ""))

    def close() -> None:
        insertions()
        if begun and empty:
            out.append((conv, None, None, None, None, 0, None, None))

    kinds: list[pa.DataType] = []
    for batch in batches:
        kinds = [batch.column(0).type, batch.column(1).type, pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
        for now, turn, role, codes, states, letters, text, repeat in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not begun or now != conv:
                close()
                conv, begun, empty, state, at = now, True, True, START, START
                todo.clear()
            if codes is not None:  # ``at``: the state behind the last block read, which may be ahead of the turns
                edits, k = letters[at], 0
                for c in edits:
                    todo.append((c, codes[k] if k < len(codes) else 0))
                    k += c != "I"
                at = states[at]
                continue
            for _ in range(repeat):
                empty = False
                insertions()
                edit, code = todo.popleft()
                fault, new = FAULTS[code >> 2], role
                cost = {"D": DELETE, "K": 0, "R": REROLE}[edit] + (CUT if fault == "truncated" and edit != "D" else 0)
                if edit == "K":
                    state = KEPT[INITIALS[code & 3]][state]
                elif edit == "R":
                    state = NEXT[state]
                    new = ROLES[state]
                kept = edit != "D"
                out.append((conv, turn, role, fault, edit, cost, new if kept else None, text if kept else None))
                size += len(text)
            if len(out) >= 4000 or size > 8 << 20:
                yield _batch(out, names, kinds)
                out.clear()
                size = 0
    close()
    if out:
        yield _batch(out, names, kinds)


def repair(turns: DataFrame, copies: Column | None = None, block: int = BLOCK) -> DataFrame:
    """The cheapest edits of every conversation of ``turns`` (columns ``conv_id, turn, role, text``).

    One row per edit: ``conv_id, turn, was_role, fault`` (of the turn; null for an insertion), ``edit`` (K keep, R rerole,
    D delete, I insert), ``cost``, and ``role, text`` of the repaired turn (null for a deletion). A partition holds whole
    conversations, in the order of their edits. ``copies``: how many times a row stands there, 0 for one that only
    names its conversation; a conversation without turns has one row without an edit.

    A null role or text counts as one space. Turns are ordered by number, nulls first, equal ones by role and a hash of the
    text. Rows repeated exactly are duplicates of the first. A role without the initial s, u or a can't be kept. A
    conversation with a null id is one like others; an empty table gives no rows; other columns are ignored. Texts may
    be of any length: they are read once, in the last step, where a conversation streams through one task (its
    digest is sequential), which holds one batch and one block's letters.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("int").alias("repeat"),
    )
    rows = rows.withColumn("name", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    bare = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(bare == "", 1).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    slim = rows.where("repeat > 0").select("conv_id", "turn", "role", "name", (kind + 4 * fault).alias("code"), "repeat")
    slim = slim.groupBy("conv_id", "turn", "role", "name").agg(F.first("code").alias("code"), F.sum("repeat").alias("repeat"))
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))  # nulls before any number
    with scratch.scope() as leave:
        slim = scratch.keep(slim)
        first = slim.groupBy(*(F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "name"))).agg(F.min(place).alias("first"))
        same = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("name") == F.col("f_name"))
        blank = F.shiftright("code", 2) == 1
        code = F.when(blank | (place == F.col("first")), F.col("code")).otherwise(F.col("code").bitwiseAND(3) + 4 * FAULTS.index("duplicate"))
        numbered = slim.join(first, same).select("conv_id", "turn", "role", "name", code.alias("code"), "repeat")
        order, kinds = ["conv_id", "turn", "role", "name"], dict(rows.dtypes)
        keys = ", ".join(f"{c} {kinds[c]}" for c in order)
        ranged = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
        blocks = scratch.keep(ranged.mapInArrow(_blocks(block), f"{keys}, block long, codes binary, matrix array<long>"))
        told = blocks.select("conv_id", "block", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_ends, "block long, before array<long>, behind array<long>, cheapest long, last boolean")
        walked = leave(scratch.keep(blocks.join(told, "block").mapInArrow(_walks, f"{keys}, block long, codes binary, states array<int>, letters array<string>")))
    none = lambda kind: F.lit(None).cast(kind)
    pieces = walked.select(*order, "block", "codes", "states", "letters", none("string").alias("text"), F.lit(0).alias("repeat"))
    told = rows.select(*order, none("long").alias("block"), none("binary").alias("codes"), none("array<int>").alias("states"), none("array<string>").alias("letters"), F.when(F.col("repeat") > 0, F.col("text")).otherwise("").alias("text"), "repeat")
    both = pieces.union(told).repartition("conv_id").sortWithinPartitions(*order, F.col("block").asc_nulls_last())
    return both.select("conv_id", "turn", "role", "codes", "states", "letters", "text", "repeat").mapInArrow(_edits, f"conv_id {kinds['conv_id']}, {EDITS.format(turn=kinds['turn'])}")


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *(x.split()[0] for x in REPORT.split(", "))]
    conv, begun, out = None, False, []

    def close() -> None:
        if begun:
            gaps = high - low + 1 - distinct if distinct else 0
            out.append((conv, gaps, *(faults[f] for f in FAULTS[1:]), illegal, cost, "".join(audit), digest.hexdigest()))

    for batch in batches:
        kinds = [batch.column(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
        for now, turn, was, fault, edit, price, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not begun or now != conv:
                close()
                conv, begun, low, high, distinct, before, illegal, cost, any_turn = now, True, None, None, 0, None, 0, 0, False
                faults, audit, digest = dict.fromkeys(FAULTS, 0), [], hashlib.sha256()
            if edit is None:
                continue
            audit.append(edit)
            cost += price
            if was is not None:
                faults[fault] += 1
                illegal += before is not None and before + was[:1] not in ("su", "ua", "au")
                before = was[:1]
                if turn is not None and turn != high:
                    low, high, distinct = turn if low is None else low, turn, distinct + 1
            if role is not None:
                digest.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode())
                any_turn = True
        if len(out) >= 2000:
            yield _batch(out, names, kinds)
            out.clear()
    close()
    if out:
        yield _batch(out, names, kinds)


def report(edits: DataFrame) -> DataFrame:
    """One row per conversation from the rows of ``repair`` as it returns them (no shuffle, so they are still in order):
    gaps in the turn numbers, turns of each fault, illegal neighbours, the cost, the letters and a digest of the repaired turns."""
    return edits.select("conv_id", "turn", "was_role", "fault", "edit", "cost", "role", "text").mapInArrow(_report, f"conv_id {dict(edits.dtypes)['conv_id']}, {REPORT}")
