"""Operator 3: n-gram Jaccard join by prefix index lists with set-relation skipping.

1. Texts with one shingle set are one *node* from here on.
2. Nodes are dealt into size levels that overlap, so that two sets which can be similar share a level.
   In a level a set needs only be looked up by the first ``n - ceil(t n) + 1`` shingles of an order
   common to all, rare ones first (prefix filter). Counts for that order are taken over all
   documents, for a share of the hash space that holds the prefixes (``region``).
3. Index lists are read in blocks: by level, and then by the other set's size and the position of the
   shingle in both sets, so blocks that can't reach the threshold are skipped. A set whose prefix has
   no shingle of another set is dropped.
4. Each list's most central set (fewest shingles of its own) is its pivot and is compared first. What is
   known of that comparison answers for its neighbours. Sets linked to the pivot are in one component. Other
   sets close to it are linked to each other only if their differences to the pivot share shingles, so
   candidates come from an index over these differences (`_derived`), not from pairs of the list. A set
   that isn't close to its list's pivot meets the list's others within the bounds of 3 and the triangle
   inequality (Jaccard distance is a metric).

Documents come out with their component, so copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import scratch
from docloom.llm.components import components
from docloom.llm.shingles import Shingler, node_of

#: Levels hold sets of up to ``8 * 2**level`` shingles. Lists of ids to look up are broadcast up to this many.
BASE, BROADCAST_ROWS, ROWS_AT_ONCE = 8, 1_000_000, 256
#: Sets are close if they differ in at most this part (1 / CLOSE) of both sets' shingles.
CLOSE = 2


def misses(n: Column | np.ndarray | int, percent: int):
    """A set of ``n`` shingles has at most so many outside a set similar to it."""
    return (n * (100 - percent)) // 100 if not isinstance(n, Column) else F.floor(n * (100 - percent) / 100)


def level_of(n: int) -> int:
    return max(0, (max(n, 1) - 1).bit_length() - 3)


def region(level: int, percent: int) -> float:
    """The share of the hash space whose shingles are counted in a level: the prefix and some more."""
    return min(1.0, (100 - percent) / 100 + 1.5 / (BASE << level) ** 0.5)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sets_of(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, whole: bool) -> DataFrame:
    """``id, node, n`` and, of each set, the smallest hashes (``tokens``) or, if ``whole``, all (``hashes``)."""
    last = T.StructField("hashes", T.BinaryType()) if whole else T.StructField("tokens", T.ArrayType(T.LongType()))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for big in batches:
            for i in range(0, len(big), ROWS_AT_ONCE):
                batch = big.slice(i, ROWS_AT_ONCE)
                sets = [shingler.hashes(t) for t in batch.column(1).to_pylist()]
                n = [len(s) for s in sets]
                nodes = pa.array([node_of(s) for s in sets], pa.int64())
                if whole:
                    kept = pa.array([s.tobytes() for s in sets], pa.binary())
                else:
                    firsts = []
                    for s in sets:
                        top = np.searchsorted(s, np.uint64(min(2**64 - 1, int(region(level_of(len(s)), percent) * 2**64))), "right")
                        firsts.append(s[: max(top, misses(len(s), percent) + 1)])
                    offsets = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
                    kept = pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(np.concatenate(firsts))))
                yield pa.RecordBatch.from_arrays([batch.column(0), nodes, pa.array(n, pa.int64()), kept], schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds to pairs ``a, b, n_a, n_b``, from the whole sets, ``common``, the size of the intersection, and
    ``apart``: the shingles that only one of both has, if these are at most a ``CLOSE``-th of all, else null."""
    one, two = (sets.select(F.col("node").alias(k), F.col("hashes").alias(f"{k}_set")) for k in "ab")
    both = pairs.join(one, "a").join(two, "b")
    schema = T.StructType([*pairs.schema.fields, T.StructField("common", T.LongType()), T.StructField("apart", T.ArrayType(T.LongType()))])
    names = [f.name for f in pairs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for i in range(0, len(big), ROWS_AT_ONCE):
                batch = big.slice(i, ROWS_AT_ONCE)
                held = [[np.frombuffer(x, dtype=np.uint64) for x in batch.column(batch.schema.get_field_index(f"{k}_set")).to_pylist()] for k in "ab"]
                common, apart = [], []
                for x, y in zip(*held, strict=True):
                    alone = np.setxor1d(x, y, assume_unique=True)
                    common.append((len(x) + len(y) - len(alone)) // 2)
                    apart.append(_signed(alone) if len(alone) * CLOSE <= len(x) + len(y) else None)
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(common, pa.int64()), pa.array(apart, pa.list_(pa.int64()))], schema.names)

    return both.mapInArrow(run, schema)


def _derived(close: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs among sets close to one pivot, from their differences to it alone.

    ``close``: ``pivot, node, n, c, apart``. Two sets differ in ``|Da| + |Db| - 2 |Da & Db|`` shingles, ``D`` being
    a set's difference to the pivot. For a pair with ``|Da| + |Db|`` within the distance that a link allows, both
    sets are linked to the pivot; every other linked pair shares shingles of the differences, at least ``|D| -
    n (1 - t) / t`` of either, so it meets in the remaining first ones of an order common to the pivot's sets.
    """
    d = F.size("apart")
    most = F.floor(F.col("n") * (100 - percent) / percent)
    first = d - F.greatest(F.lit(1), d - most) + 1
    each = close.select("pivot", "node", "n", "c", d.alias("d"), first.cast("int").alias("first"), F.explode("apart").alias("t"))
    held = scratch.keep(each)
    shared = held.groupBy("pivot", "t").agg(F.count("*").alias("times"), F.min("c").alias("x"), F.max("c").alias("y")).where("times > 1")
    # Shingles that no other set has are never shared: they come first in the order. The others are sorted, rare ones first.
    found = held.join(shared, ["pivot", "t"]).groupBy("pivot", "node").agg(
        *[F.first(k).alias(k) for k in ("n", "c", "d", "first")], F.array_sort(F.collect_list(F.struct("times", "t", (F.col("x") != F.col("y")).alias("mixed")))).alias("found")
    )
    own = F.col("d") - F.size("found")
    entry = found.withColumn("own", own).where(F.col("own") < F.col("first"))
    entry = entry.select("pivot", "node", "n", "c", "d", "own", F.posexplode(F.slice("found", F.lit(1), F.col("first") - F.col("own"))).alias("i", "x"))
    entry = scratch.keep(entry.where("x.mixed").select("pivot", F.col("x.t").alias("t"), "node", "n", "c", "d", (F.col("own") + F.col("i")).alias("at")))
    p, q = entry.alias("p"), entry.alias("q")
    need = (F.col("p.d") + F.col("q.d")) * (100 + percent) - (F.col("p.n") + F.col("q.n")) * (100 - percent)  # twice (100 + percent) times the shared ones
    left = F.least(F.col("p.d") - F.col("p.at"), F.col("q.d") - F.col("q.at"))
    met = (F.col("p.pivot") == F.col("q.pivot")) & (F.col("p.t") == F.col("q.t")) & (F.col("p.node") < F.col("q.node")) & (F.col("p.c") != F.col("q.c"))
    pairs = p.join(q, met & (need <= 2 * (100 + percent) * left))
    return pairs.select(F.col("p.node").alias("a"), F.col("q.node").alias("b"), F.col("p.n").alias("n_a"), F.col("q.n").alias("n_b")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """``id, n_shingles, component_id`` for every row: its set's size and the smallest id reachable by links.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their distinct shingles of
    ``size`` words (fewer words: the whole sequence is the one shingle). A null or wordless text has an
    empty set, links with nothing, and is its own component. Repeated rows are kept; they are one
    component as copies are. A null id is in its component but never its smallest unless all are null.
    An empty table gives no rows; further columns are not looked at.
    """
    with scratch.scope() as leave:
        return leave(scratch.keep(_components(docs, id_col, text_col, size, percent)))


def _components(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    signed = scratch.keep(sets_of(docs, id_col, text_col, size, percent, whole=False))
    linkable = signed.where("n > 0")
    # (level, shingle) -> how many have it; those of one node alone are no list.
    n = F.col("n")
    own = F.greatest(F.lit(0), F.length(F.bin(n - 1)) - 3)  # level_of()
    up = F.floor(n * 100 / percent) > BASE * F.pow(F.lit(2.0), own)  # a set similar to it can be in the level above
    levels = F.array_compact(F.array(own, F.when(up, own + 1)))
    spread = linkable.select("node", "n", F.explode(levels).alias("level"), "tokens")
    shares = F.array(*[F.lit(region(i, percent)) for i in range(48)])
    # Shingles under the level's share of the hash space are counted; of a set with too few of these, the next by hash are taken too.
    limit = F.when(F.get(shares, F.col("level")) >= 1, F.lit(2.0**63)).otherwise(F.get(shares, F.col("level")) * 2.0**64 - 2.0**63)
    unsigned = F.transform("tokens", lambda t: t.bitwiseXOR(F.lit(-(2**63)).cast("long")))  # in the order of the hashes
    prefix = misses(F.col("n"), percent) + 1
    spread = spread.withColumn("tokens", unsigned)
    inside = F.filter("tokens", lambda t, i: (t.cast("double") < F.col("limit")) | (i < F.col("prefix")))
    spread = spread.withColumn("limit", limit).withColumn("prefix", prefix).withColumn("tokens", inside)
    entries = spread.select("node", "n", "level", "prefix", F.size("tokens").alias("held"), F.explode("tokens").alias("t"), "limit")
    entries = entries.withColumn("counted", F.col("t").cast("double") < F.col("limit")).drop("limit").withColumn("key", F.xxhash64("t", "level"))
    lists = scratch.keep(entries.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.count("*").alias("df")).where("x <> y").select("key", "df"))
    # Of each set the shared shingles, rare ones first; the others of its counted shingles come before them in the order.
    shared = entries.join(lists, "key").groupBy("node", "level").agg(
        F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.array_sort(F.collect_set(F.struct(~F.col("counted"), F.when(F.col("counted"), F.col("df")).otherwise(0), "t", "key"))).alias("found")
    )
    alone = spread.select("node", "level", F.size(F.filter("tokens", lambda t: t.cast("double") < F.col("limit"))).alias("counted")).distinct()
    shared = shared.where(F.size("found") > 0).join(alone, ["node", "level"])
    own_only = F.col("counted") - F.size(F.filter("found", lambda x: ~x["col1"]))
    shared = shared.withColumn("own_only", own_only).where(F.col("own_only") < F.col("prefix"))
    entry = shared.select("node", "level", "n", "own_only", F.posexplode(F.slice("found", F.lit(1), F.greatest(F.lit(0), F.col("prefix") - F.col("own_only")).cast("int"))).alias("i", "x"))
    entry = entry.select("node", "n", "own_only", (F.col("i") + F.col("own_only")).alias("pos"), F.col("x.key").alias("key"))
    index = scratch.keep(entry)
    pivots = scratch.keep(index.groupBy("key").agg(F.min(F.struct("own_only", "node", "n", "pos")).alias("p"), F.max("node").alias("y"), F.min("node").alias("x")).where("x <> y").select("key", "p"))

    def possible(n1: Column, n2: Column, pos1: Column, pos2: Column, own1: Column, own2: Column) -> Column:
        """The least overlap needed, against what the sizes, the sets' own shingles and the positions leave."""
        need = F.ceil((n1 + n2) * percent / (100 + percent))
        before, after = F.least(pos1 - own1, pos2 - own2), F.least(n1 - pos1, n2 - pos2)
        return (F.least(n1 - own1, n2 - own2) >= need) & (before + after >= need)

    # First round: each set and the pivots of its lists.
    star = index.join(pivots, "key").where("node <> p.node").where(possible(F.col("n"), F.col("p.n"), F.col("pos"), F.col("p.pos"), F.col("own_only"), F.col("p.own_only")))
    star = scratch.keep(star.groupBy(F.col("node").alias("a"), F.col("p.node").alias("b")).agg(F.first("n").alias("n_a"), F.first("p.n").alias("n_b")))
    members = index.join(pivots.select("key"), "key", "left_semi").select("node").distinct()
    wanted = scratch.keep(members.join(linkable.select("node", "id"), "node").groupBy("node").agg(F.min("id").alias("id")))
    ids = wanted.select(F.col("id").alias("wanted_id")).distinct()
    if wanted.count() <= BROADCAST_ROWS:  # else the texts are dealt by their id
        ids = F.broadcast(ids)
    texts = docs.join(ids, F.col(id_col).eqNullSafe(F.col("wanted_id")), "left_semi")
    whole = sets_of(texts, id_col, text_col, size, percent, whole=True)
    sets = scratch.keep(whole.groupBy("node").agg(F.first("hashes").alias("hashes")))
    enough = F.col("common") * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))
    measured = scratch.keep(_compared(star, sets))
    # A set that the bounds keep from a list's pivot, but not from sets close to it, is measured too.
    seats = index.join(pivots.select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("n_pivot")), "key").where("node <> pivot")
    told = measured.select(F.col("a").alias("node"), F.col("b").alias("pivot"), F.col("apart").isNotNull().alias("close"))
    told = scratch.keep(seats.join(told, ["node", "pivot"], "left"))
    open_lists = told.groupBy("key").agg(F.bool_or("close").alias("any"), F.bool_or(F.col("close").isNull()).alias("open")).where("any AND open").select("key")
    rest = told.where("close IS NULL").join(open_lists, "key", "left_semi").select(F.col("node").alias("a"), F.col("pivot").alias("b"), F.col("n").alias("n_a"), F.col("n_pivot").alias("n_b")).distinct()
    measured = measured.union(scratch.keep(_compared(scratch.keep(rest), sets)))
    linked = measured.where(enough).select("a", "b")
    first = scratch.keep(components(linked))
    # Second round: pairs in different components. Sets close to a list's pivot are compared by what they differ in from it.
    state = scratch.keep(members.join(first, "node", "left").select("node", F.coalesce("component", "node").alias("c")))
    near = measured.where("apart IS NOT NULL").select(F.col("b").alias("pivot"), F.col("a").alias("node"), F.col("n_a").alias("n"), "apart")
    derived = _derived(near.join(state, "node"), percent)
    # The other sets of a list meet all of it: what keeps them apart is their distance to the pivot, their size and position.
    known = measured.select(F.col("a").alias("node"), F.col("b").alias("pivot"), (F.col("n_a") + F.col("n_b") - 2 * F.col("common")).alias("far"), F.col("apart").isNotNull().alias("close"))
    placed = seats.join(state, "node").join(known, ["node", "pivot"], "left")
    placed = scratch.keep(placed.withColumn("close", F.coalesce("close", F.lit(False))).drop("pivot", "n_pivot"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("close").alias("all_close")).where("lo <> hi AND NOT all_close").select("key")
    placed = scratch.keep(placed.join(mixed, "key", "left_semi"))
    a, b = placed.where("NOT close").alias("p"), placed.alias("q")
    apart = F.col("p.far").isNull() | F.col("q.far").isNull() | (F.abs(F.col("p.far") - F.col("q.far")) * (100 + percent) <= (100 - percent) * (F.col("p.n") + F.col("q.n")))
    fits = possible(F.col("p.n"), F.col("q.n"), F.col("p.pos"), F.col("q.pos"), F.col("p.own_only"), F.col("q.own_only"))
    once = F.col("q.close") | (F.col("p.node") < F.col("q.node"))
    pairs = a.join(b, (F.col("p.key") == F.col("q.key")) & (F.col("p.node") != F.col("q.node")) & once & (F.col("p.c") != F.col("q.c")) & apart & fits)
    pairs = pairs.select(F.col("p.node").alias("a"), F.col("q.node").alias("b"), F.col("p.n").alias("n_a"), F.col("q.n").alias("n_b"))
    more = _compared(scratch.keep(derived.union(pairs).distinct()), sets).where(enough).select("a", "b")
    final = components(linked.union(more))
    smallest = signed.where("n > 0").groupBy("node").agg(F.min("id").alias("id"))
    named = scratch.keep(smallest.join(final, "node", "left").select("node", "id", F.coalesce("component", "node").alias("c")))
    by_component = scratch.keep(named.groupBy("c").agg(F.min("id").alias("component_id")))
    names = scratch.keep(named.join(by_component, "c").select("node", "component_id"))
    rows = signed.where("n > 0").select("id", "n", "node").join(names, "node").select("id", "n", "component_id")
    rows = rows.union(signed.where("n = 0").select("id", "n", "id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
