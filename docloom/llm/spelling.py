"""Spelling variants: words at edit distance one, and the commoner form that each of them leads to.

The vocabulary is cut into shards of sorted words. A shard is a compact trie: nodes in level order, so that a node's
children lie side by side, split only as far as words differ, with the rest of a word kept at its leaf. Shards are
broadcast in rounds of bounded size, and every word's distance-one Levenshtein automaton walks each shard depth-first.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch

#: The letters of a word, once A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
#: Characters of a shard's words at most (a longer word makes a shard of its own), bytes of a round's shards, and words that a
#: task takes through them (about half a millisecond each for 500,000 words in 13 shards).
SHARD_CHARACTERS, ROUND_BYTES, TASK_WORDS = 400_000, 32 << 20, 10_000
SHARD = "shard long, labels string, first binary, tails array<string>, counts binary"


def count_words(docs: DataFrame, least_length: int = 6, least_count: int = 5, dropped: int = 199) -> DataFrame:
    """``word, n``: runs of letters of whole texts, A-Z lower-cased, with a letter taken out of one run in ``dropped``.

    The hash of ``<doc_id>:<run>`` chooses runs and letters (null ids count as empty). Words of fewer code points or
    occurrences are left out; null and empty texts have none, a text may be of any length, repeated rows count each.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = F.regexp_extract_all(F.translate("text", upper, upper.lower()), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    found = found.select("run", F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % dropped == 0, F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))
    return found.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Trie:
    """``first[v]`` to ``first[v + 1]`` are the children of node ``v``, with their ``labels``. A node's ``tails`` entry is
    None if no word ends below it without a branch, else the rest of that word; ``counts`` are the words' numbers."""

    def __init__(self, labels: str, first: array, tails: list[str | None], counts: array):
        self.labels, self.first, self.tails, self.counts = labels, first, tails, counts

    @classmethod
    def of(cls, words: list[str], counts: list[int]) -> Trie:
        """``words`` sorted and distinct."""
        labels, first, tails, numbers = ["\0"], array("q"), [], array("q")
        level = [(0, len(words), 0)]
        made = 1
        while level:
            below = []
            for low, high, depth in level:
                first.append(made)
                if high - low == 1:  # the rest of the only word stays here
                    tails.append(words[low][depth:])
                    numbers.append(counts[low])
                    continue
                ends = len(words[low]) == depth  # the least word may end at a branch
                tails.append("" if ends else None)
                numbers.append(counts[low] if ends else 0)
                low += ends
                while low < high:
                    letter, stop = words[low][depth], low + 1
                    while stop < high and words[stop][depth] == letter:
                        stop += 1
                    labels.append(letter)
                    made += 1
                    below.append((low, stop, depth + 1))
                    low = stop
            level = below
        first.append(made)
        return cls("".join(labels), first, tails, numbers)

    def near(self, word: str) -> Iterator[tuple[str, int]]:
        """Words at distance one, with their counts.

        A state is an exact prefix or positions in ``word`` behind one edit; letters that no state goes on with are not tried.
        """
        labels, first, tails, counts, size = self.labels, self.first, self.tails, self.counts, len(word)
        # node, its letters so far, whether they are the word's, else the positions behind one edit
        stack = [(0, "", True, ())]
        while stack:
            node, prefix, exact, edited = stack.pop()
            depth, tail = len(prefix), tails[node]
            if tail is not None:
                rest = word[depth:]
                if exact:
                    if tail != rest and _one_apart(rest, tail):
                        yield prefix + tail, counts[node]
                elif any(word[i:] == tail for i in edited):
                    yield prefix + tail, counts[node]
            low, high = first[node], first[node + 1]
            if low == high:
                continue
            if not exact:
                for letter in {word[i] for i in edited if i < size}:
                    child = labels.find(letter, low, high)
                    if child >= 0:
                        stack.append((child, prefix + letter, False, tuple(i + 1 for i in edited if i < size and word[i] == letter)))
                continue
            follow = word[depth] if depth < size else ""
            skipped = word[depth + 1] if depth + 1 < size else ""
            for child in range(low, high):
                letter = labels[child]
                if letter == follow:
                    stack.append((child, prefix + letter, True, ()))
                    continue
                after = (depth, depth + 1) if depth < size else (depth,)  # inserted or replaced
                stack.append((child, prefix + letter, False, (*after, depth + 2) if letter == skipped else after))


def _one_apart(one: str, two: str) -> bool:
    """Whether two different texts differ by one inserted, deleted or replaced letter."""
    if abs(len(one) - len(two)) > 1:
        return False
    low, high = 0, min(len(one), len(two))
    while low < high:  # the length of the common beginning
        middle = (low + high + 1) // 2
        if one[low:middle] == two[low:middle]:
            low = middle
        else:
            high = middle - 1
    return one[low + (len(one) >= len(two)) :] == two[low + (len(two) >= len(one)) :]


def _tries(characters: int):
    """Sorted words of a partition as shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, size = [], [], 0

        def shard() -> pa.RecordBatch:
            t = Trie.of(words, counts)
            columns = [pa.array([sum(map(len, words))], pa.int64()), pa.array([t.labels]), pa.array([t.first.tobytes()]), pa.array([t.tails], pa.list_(pa.string())), pa.array([t.counts.tobytes()])]
            return pa.RecordBatch.from_arrays(columns, ["shard", "labels", "first", "tails", "counts"])

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if words and size + len(word) > characters:
                    yield shard()
                    words, counts, size = [], [], 0
                words.append(word)
                counts.append(n)
                size += len(word)
        if words:
            yield shard()

    return run


def _matched(shards):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = []
        for x in shards.value:
            first, counts = array("q"), array("q")
            first.frombytes(x["first"])
            counts.frombytes(x["counts"])
            tries.append(Trie(x["labels"], first, x["tails"], counts))
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                count, best = 0, None
                for trie in tries:
                    for other, n in trie.near(word):
                        count += 1
                        if best is None or (-n, other) < best:
                            best = (-n, other)
                if count:
                    out.append((word, count, best[1], -best[0]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 4, [pa.string(), pa.int64(), pa.string(), pa.int64()], strict=True)], ["word", "n_near", "near", "near_n"])

    return run


def near_words(words: DataFrame, characters: int = SHARD_CHARACTERS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``word, n_near, near, near_n``: how many of the distinct ``words`` (columns ``word, n``) are one edit away from each, and
    the commonest of them (the smallest of equals). Words without any are left out.

    A round's shards pass through the driver, ``round_bytes`` and one shard at most; what comes back is a row per word and round.
    """
    ranged = words.select("word", "n").repartitionByRange("word").sortWithinPartitions("word")
    shards = scratch.keep(ranged.mapInArrow(_tries(characters), SHARD).withColumn("shard", F.monotonically_increasing_id()))
    size = F.octet_length("labels") + F.octet_length("first") + F.octet_length("counts") + F.size("tails") * 16 + F.aggregate("tails", F.lit(0), lambda s, t: s + F.coalesce(F.octet_length(t), F.lit(0)))
    rounds, used = [[]], 0
    for x in shards.select("shard", size.alias("bytes")).orderBy("shard").toLocalIterator():  # numbers alone
        if rounds[-1] and used + x.bytes > round_bytes:
            rounds.append([])
            used = 0
        rounds[-1].append(x.shard)
        used += x.bytes
    context, found, tasks = words.sparkSession.sparkContext, [], 1 + words.count() // TASK_WORDS
    for part in rounds:
        own = context.broadcast([x.asDict() for x in shards.where(F.col("shard").isin(part)).collect()])
        found.append(scratch.keep(words.select("word").repartition(tasks, "word").mapInArrow(_matched(own), "word string, n_near long, near string, near_n long")))
        own.unpersist()
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    return reduce(DataFrame.union, found).groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.near", (-F.col("best.n")).alias("near_n"))


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table of distinct words with their counts ``n``.

    A word's form is its commonest near word if that occurs ``ratio`` times as often, its root the last of the forms that follow
    each other (counts grow, so they end). A word without near words has ``n_near`` 0; an empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("a form has to occur twice as often at least")
    with scratch.scope() as leave:
        words = leave(scratch.keep(words.select("word", "n")))
        near = near_words(words)
        found = leave(scratch.keep(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("near_n") >= ratio * F.col("n"), F.struct("near", "near_n")).alias("f"))))
        roots = scratch.keep(found.where("f IS NOT NULL").select("word", F.col("f.near").alias("root")))
        while True:  # each round doubles the steps that a root is away
            onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
            new = scratch.keep(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
            scratch.drop(roots)
            roots = scratch.keep(new.select("word", "root")) if (more := not new.where("moved").isEmpty()) else leave(new)
            if not more:
                break
            scratch.drop(new)
    return found.join(roots.select("word", "root"), "word", "left").select("word", F.col("f.near").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("f.near_n").alias("form_n"))
