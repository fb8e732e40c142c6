"""Operator 8: toxicity by the nearest labelled examples.

Texts become TF-IDF vectors over all words of the labelled examples, a sample of at most ``FIT_ROWS``. Words that
tell the labels apart weigh more, others ``WEAK`` of it at least: no word is left out, so every text with a known word
has neighbours. The examples are kept in an inverted index. Lists of words in at least a ``FREQUENT``-th of the examples are
cut into blocks of examples, with each block's largest weight. A document reads its short lists, and of the long ones
the blocks whose bound can still bring an example among its ``k`` nearest, so the neighbours are exact. Their labels vote with weights that fall with the cosine distance.

Only the model, of a size that ``FIT_ROWS`` and ``FEATURES`` (a bound of memory, those of most documents) bound, is broadcast; it is fitted on the
sample alone, and every whole document is scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import scratch

#: Labelled rows that are learned from, at most (those of the smallest hashes), and words, at most (the most frequent).
FIT_ROWS, FEATURES = 3_000, 400_000
NEAREST, BLOCK, FREQUENT, WEAK, TELLING = 25, 32, 16, 0.05, 4.0
#: Parts of texts whose words a worker remembers, at most: the memory counts once for each worker.
REMEMBERED = 60_000
WORDS = re.compile(r"[^\W\d_]+")
EVIDENCE = "array<struct<id:string,toxic:int,cosine:double>>"


def telling(z: float) -> float:
    """What a word's weight is multiplied by, from how many deviations apart its shares among the labels are."""
    return WEAK + (1 - WEAK) * min(1.0, (abs(z) / TELLING) ** 4)


@dataclass
class Model:
    """Examples sorted into blocks, and inverted lists. A short list's examples and weights begin in ``at`` and ``weight``
    at ``lists[word]``; a long list is row ``row[word]`` of ``wide`` (its weights by example) and ``top`` (the largest of each block)."""

    idf: dict[str, tuple[int, float]]
    prior: float  # share of toxic examples
    blank: float  # the same among examples without a known feature
    ids: list[str] = field(default_factory=list)
    toxic: np.ndarray = field(default_factory=lambda: np.empty(0))
    at: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int32))
    weight: np.ndarray = field(default_factory=lambda: np.empty(0))
    lists: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))
    row: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int32))
    wide: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    top: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    memo: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def vector(self, text: str | None) -> dict[int, float]:
        """Feature -> weight, of length 1; empty for a text without a known feature."""
        counts: dict[int, int] = {}
        memo = self.memo
        for part, n in Counter((text or "").lower().split()).items():  # white space is in no word, so parts can be remembered
            if (found := memo.get(part)) is None:
                found = tuple(self.idf[word] for word in WORDS.findall(part) if word in self.idf)
                if len(memo) < REMEMBERED:
                    memo[part] = found
            for x in found:
                counts[x] = counts.get(x, 0) + n
        if not counts:
            return {}
        weights = (1 + np.log(np.fromiter(counts.values(), float, len(counts)))) * np.array([w for _, w in counts])
        return dict(zip((i for i, _ in counts), (weights / math.sqrt((weights**2).sum())).tolist(), strict=True))

    def index(self, examples: list[tuple[str, int, dict[int, float]]]) -> None:
        """Builds the lists from examples' ids, labels and vectors."""
        arrays = [(np.fromiter(v, np.int32, len(v)), np.fromiter(v.values(), float, len(v))) for _, _, v in examples]
        self.index_arrays([x[0] for x in examples], [x[1] for x in examples], [x[0] for x in arrays], [x[1] for x in arrays])

    def index_arrays(self, ids: list[str], toxic: list[int], words: list[np.ndarray], weights: list[np.ndarray]) -> None:
        """Examples with the same strongest word become neighbours, so that blocks differ."""
        strongest = [max(zip(w.tolist(), i.tolist(), strict=True))[1] for i, w in zip(words, weights, strict=True)]
        turn = sorted(range(len(ids)), key=lambda x: (strongest[x], toxic[x], ids[x]))
        self.ids, self.toxic = [ids[x] for x in turn], np.array([toxic[x] for x in turn], dtype=float)
        n, blocks = len(ids), -(-len(ids) // BLOCK)
        at = np.repeat(np.arange(n, dtype=np.int32), [len(words[x]) for x in turn])
        feature = np.concatenate([words[x] for x in turn]) if n else np.empty(0, dtype=np.int32)
        weight = np.concatenate([weights[x] for x in turn]) if n else np.empty(0)
        order = np.lexsort((at, feature))
        feature, at, weight = feature[order], at[order], weight[order]
        often = np.flatnonzero(np.bincount(feature, minlength=len(self.idf)) * FREQUENT >= max(n, 1))
        self.row = np.full(len(self.idf), -1, dtype=np.int32)
        self.row[often] = np.arange(len(often))
        long = self.row[feature] >= 0
        self.wide = np.zeros((len(often), blocks * BLOCK))
        self.wide[self.row[feature[long]], at[long]] = weight[long]
        self.top = self.wide.reshape(len(often), blocks, BLOCK).max(2)
        self.at, self.weight = at[~long], weight[~long]
        self.lists = np.searchsorted(feature[~long], np.arange(len(self.idf) + 1))

    def nearest(self, vector: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the largest cosine and these, ties to the earlier example; only cosines over 0."""
        n = len(self.ids)
        if not n:
            return np.empty(0, dtype=np.int64), np.empty(0)
        words, q = np.fromiter(vector, np.int64, len(vector)), np.fromiter(vector.values(), float, len(vector))
        row = self.row[words]
        short, long = row < 0, row >= 0
        begin = self.lists[words[short]]
        sizes = self.lists[words[short] + 1] - begin
        places = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        scores = np.bincount(self.at[places], np.repeat(q[short], sizes) * self.weight[places], minlength=self.wide.shape[1])
        if long.any():
            asked = np.zeros(len(self.wide))
            asked[row[long]] = q[long]
            least = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
            live = np.flatnonzero(scores.reshape(-1, BLOCK).max(1) + asked @ self.top + 1e-12 >= least)
            rows = (live[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            # Reading a few blocks means copying them, so most blocks are read as all are.
            whole = scores[rows] + ((asked @ self.wide)[rows] if 8 * len(rows) > len(scores) else q[long] @ self.wide[np.ix_(row[long], rows)])
        else:
            rows, whole = np.arange(len(scores)), scores
        held = whole > 0
        if held.sum() > 4 * k:
            held &= whole >= np.partition(whole, -k)[-k]
        at, cosine = rows[held], whole[held]
        pick = np.lexsort((at, -cosine))[:k]
        return at[pick], cosine[pick]

    def score(self, text: str | None, k: int = NEAREST) -> tuple[float, list[dict]]:
        """The weighted share of toxic neighbours, with the prior as one weak vote, and the neighbours that weigh most."""
        vector = self.vector(text)
        at, cosine = self.nearest(vector, k) if vector else (np.empty(0, dtype=np.int64), np.empty(0))
        if not len(at):
            return self.blank, []
        weight = 1 / (1.05 - np.minimum(cosine, 1.0))
        value = float(((weight * self.toxic[at]).sum() + 0.5 * self.prior) / (weight.sum() + 0.5))
        return value, [{"id": self.ids[a], "toxic": int(self.toxic[a]), "cosine": float(c)} for a, c in zip(at[:3], cosine[:3], strict=True)]


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """Learns from labelled documents that aren't held out, at most ``rows`` of them, chosen by a hash of the id.

    Labels other than 0 and 1 and null ids are left out; an id labelled twice counts as toxic if one label does;
    of rows that share an id the smallest text is taken.
    """
    with scratch.scope():
        return _fitted(docs, labels, id_col, text_col, label_col, rows)


def _fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> Model:
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    sample = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).dropna(subset=["id"])
    found = texts.join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))  # at most `rows`
    sample = scratch.keep(found.select(F.col("id").cast("string"), "text", "toxic"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                both[toxic].update(set(WORDS.findall((text or "").lower())))
        names = list(both[0] | both[1])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in both)], ["feature", "clean", "toxic"])

    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    prior = toxic / max(1, clean + toxic)
    if not clean or not toxic:
        return Model({}, prior, prior)
    table = sample.mapInArrow(counted, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("b"), F.sum("toxic").alias("a"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic - F.col("a") + 0.5)) - F.log(b / (clean - F.col("b") + 0.5))
    z = odds / F.sqrt(1 / a + 1 / b + 1 / (toxic - F.col("a") + 0.5) + 1 / (clean - F.col("b") + 0.5))
    kept = table.withColumn("z", z).orderBy(F.desc(F.col("a") + F.col("b")), "feature").limit(FEATURES)
    found = kept.select("feature", (F.col("a") + F.col("b")).alias("n"), "z").toArrow()  # at most `FEATURES` rows
    columns = zip(found["feature"].to_pylist(), found["n"].to_numpy(), found["z"].to_numpy(), strict=True)
    idf = {word: (i, telling(z) * (math.log((clean + toxic + 1) / (n + 1)) + 1)) for i, (word, n, z) in enumerate(columns)}
    model = Model(idf, prior, prior)
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.vector(t) for t in batch.column(1).to_pylist()]
            places = pa.array([list(v) for v in found], pa.list_(pa.int32()))
            weights = pa.array([list(v.values()) for v in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), places, weights], ["id", "toxic", "places", "weights"])

    examples = sample.mapInArrow(vectors, "id string, toxic int, places array<int>, weights array<double>").toArrow()  # at most `rows`
    shared.destroy()
    known = np.array([len(x) > 0 for x in examples["places"]], dtype=bool)
    blank = examples["toxic"].to_numpy()[~known]
    model = Model(idf, prior, float((blank.sum() + prior) / (len(blank) + 1)))
    examples = examples.filter(pa.array(known))
    arrays = [[x.values.to_numpy() for x in examples[c]] for c in ("places", "weights")]
    model.index_arrays(examples["id"].to_pylist(), examples["toxic"].to_pylist(), *arrays)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", k: int = NEAREST) -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` (1 from 0.5) and ``evidence`` (the nearest examples) to every row.

    The score depends on the text alone. Null and empty texts, and texts without a known feature, get
    the share of toxic examples among such texts. Without any fitted example every score is that of the
    prior, 0 where nothing is labelled toxic. Columns of these names are replaced; repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted", "evidence")
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", T._parse_datatype_string(EVIDENCE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("id", pa.string()), ("toxic", pa.int32()), ("cosine", pa.float64())]))
        for big in batches:
            for i in range(0, len(big), 512):
                batch = big.slice(i, 512)
                found = [shared.value.score(t, k) for t in batch.column(at).cast(pa.string()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], kind)], schema.names)

    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
