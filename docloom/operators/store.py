"""Collections of points: Parquet partitioned by ranges (or hashes) of the key, of which a change rewrites only what it touches.

A change is prepared in ``staged/<batch>``: the new rows (computed once, laid out as they will be stored), the rows that stay of
partitions where some go, and what the change adds to the inverted and vector indexes. Once its ``plan.json`` is there, it is
published by steps that may be repeated: the files that the plan names go, the new ones are renamed into the partitions, where
files of partitions that lose no row stay; additions by a rename, and a line in the ``ledger`` at the end. A
writer that finds a sealed change of an interrupted one publishes it first; one that isn't sealed never happened. A
batch that stands in the ledger isn't written again. One writer at a time; a reader that has begun before a change of its
partitions has to begin anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators import postings
from docloom.operators.vector_index import VectorIndex
from docloom.sources.files import Files

PART, AT = "docloom_part", "docloom_at"
#: Keys are broadcast up to so many, so that the rows they are looked up for needn't be shuffled.
BROADCAST_KEYS = 4_000_000
#: A partition with so many files under ``SMALL_BYTES`` is written anew with the next change of it.
MOST_SMALL, SMALL_BYTES = 32, 8 << 20


class Collection:
    """A folder of rows with a key. The settings of an existing collection are read from it, those given here make a new one.

    ``width``: keys ``n * width`` to ``(n + 1) * width - 1`` are one partition, so a load of new keys leaves the older ones alone;
    without it keys are hashed to ``buckets`` partitions. ``text``: the column of an inverted index kept beside the rows.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "id", width: int | None = None, buckets: int = 64, text: str | None = None, sort_by: list[str] | None = None):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)
        self.settings = self.files.read("collection.json") or {"key": key, "width": width, "buckets": buckets, "text": text, "sort_by": sort_by or [key], "schema": None, "indexes": []}

    @property
    def key(self) -> str:
        return self.settings["key"]

    @property
    def text(self) -> str | None:
        return self.settings["text"]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.settings["schema"])

    def exists(self) -> bool:
        return self.settings["schema"] is not None and self.files.exists("collection.json")

    def ensure(self, schema: T.StructType) -> bool:
        """Makes an empty collection if there is none; one that exists is taken as it is. True if made."""
        if self.exists():
            return False
        self._set(schema=schema.jsonValue())
        return True

    def _set(self, **changes) -> None:
        self.settings |= changes
        self.files.write("collection.json", self.settings)

    # ---- reading

    def part(self, key: Column | str) -> Column:
        value = F.col(key) if isinstance(key, str) else key
        if self.settings["width"]:
            width = F.lit(self.settings["width"])
            return F.call_function("div", value - F.pmod(value, width), width).cast("long")  # whole numbers all the way
        return F.pmod(F.xxhash64(value), F.lit(self.settings["buckets"])).cast("long")

    def _rows(self, parts: list[int] | None = None) -> DataFrame:
        schema = _with_part(self.schema)
        if not self.files.exists("rows"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        return rows if parts is None else rows.where(F.col(PART).isin(parts))

    def read(self, *columns: str) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no collection at {self.path}")
        df = self._rows().drop(PART)
        return df.select(*columns) if columns else df

    def between(self, low: int, high: int) -> DataFrame:
        """Rows of keys ``low`` to ``high``; of a collection by ranges, only their partitions are read."""
        found, width = self._rows(), self.settings["width"]
        found = found.where(F.col(PART).between(low // width, high // width)) if width else found
        return found.where(F.col(self.key).between(low, high)).drop(PART)

    def of_keys(self, keys: list) -> DataFrame:
        """Rows of a few keys; only their partitions are read."""
        if not keys:
            return self._rows([]).drop(PART)
        kind = self.schema[self.key].dataType
        parts = [r[0] for r in self.spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("k", kind)])).select(self.part("k")).distinct().collect()]
        return self._rows(parts).where(F.col(self.key).isin(keys)).drop(PART)

    # ---- payload indexes

    def create_index(self, column: str) -> bool:
        """An index of a payload column: which partitions hold which values. False if there is one already.

        Partitions written from now on are also sorted by it, with a Bloom filter in their files.
        """
        if column in self.settings["indexes"]:
            return False
        if self.exists() and column in self.schema.names:
            self._write_index(column, self._rows())
        self._set(indexes=[*self.settings["indexes"], column])
        return True

    def _write_index(self, column: str, rows: DataFrame) -> None:
        found = rows.select(F.col(column).alias("value"), PART).distinct()
        found.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{self.path}/index/{column}")

    def where(self, column: str, low, high=None) -> DataFrame:
        """Rows whose indexed column is ``low``, or lies from ``low`` to ``high``; only partitions that hold such rows are read."""
        wanted = lambda c: c.between(low, high) if high is not None else c == low
        if column not in self.settings["indexes"] or not self.files.exists(f"index/{column}"):
            return self.read().where(wanted(F.col(column)))
        kind = self.schema[column].dataType.simpleString()
        index = self.spark.read.schema(f"value {kind}, {PART} long").parquet(f"{self.path}/index/{column}")
        parts = [r[0] for r in index.where(wanted(F.col("value"))).select(PART).distinct().collect()]  # as many as partitions at most
        return self._rows(parts).where(wanted(F.col(column))).drop(PART)

    # ---- changes

    def done(self, batch: str) -> bool:
        return self.files.exists(f"ledger/{batch}.json")

    def ledger(self) -> list[dict]:
        """What every batch has written: its name, rows, and the counters given with it."""
        return [self.files.read(f"ledger/{name}") for name in self.files.names("ledger") if name.endswith(".json")]

    def upsert(self, new: DataFrame, order: Column | None = None, replace: str | None = None, batch: str | None = None, count: Callable[[DataFrame], dict] | None = None) -> bool:
        """Rows of ``new`` take the place of stored rows with their key; of equal keys the last by ``order`` wins,
        without it the last in the order in which ``new`` is read.

        ``replace``: a column such as the case id whose stored rows all go when ``new`` has its value. ``batch``: a name; one that
        is in the ledger already isn't written again (False). ``count``: counters of the stored new rows for the ledger. The
        plan of ``new`` runs once, as its embedder may be a paid service. Rows without a key are an error.
        """
        batch = self._begin(batch)
        if batch is None:
            return False
        if not self.exists():
            self.ensure(new.schema)
        stage, stored = f"staged/{batch}", self.schema
        typed = [F.col(f.name).cast(stored[f.name].dataType).alias(f.name) if f.name in stored.names else F.col(f.name) for f in new.schema]
        at = F.monotonically_increasing_id() if order is None else order
        told = new.withColumn(AT, at).select(*typed, AT).withColumn(PART, self.part(self.key))
        self._write_rows(told.hint("rebalance", PART), f"{stage}/new")  # a partition of many rows is split
        given = self.spark.read.schema(told.schema).parquet(f"{self.path}/{stage}/new")
        if not given.groupBy(self.key).count().where("count > 1").isEmpty():
            self._write_rows(merge_rows(None, given, self.key, F.col(AT)).hint("rebalance", PART), f"{stage}/once")
            self.files.delete(f"{stage}/new")
            self.files.rename(f"{stage}/once", f"{stage}/new")
        self._widen(told.drop(AT, PART).schema)
        touched = self._parts(f"{stage}/new")
        if None in touched:
            raise ValueError("rows without a key")
        fresh = self.spark.read.schema(told.drop(AT).schema).parquet(f"{self.path}/{stage}/new")
        by = replace or self.key
        named, keys = (_looked_up(fresh.select(c).distinct()) for c in (by, self.key))
        old = self._rows() if replace else self._rows(touched)
        found = old.join(named, by, "left_semi").select(PART)
        if replace:  # a row that has gone over to another case
            found = found.union(old.join(keys, self.key, "left_semi").select(PART))
        parts = {r[0] for r in found.distinct().collect()}
        parts |= {p for p in touched if sum(n < SMALL_BYTES for n in self.files.sizes(f"rows/{PART}={p}").values()) >= MOST_SMALL}
        gone = rest = None
        if parts:
            old = self._rows(sorted(parts))
            gone, rest = old.join(named, by, "left_semi"), old.join(named, by, "left_anti")
            if replace:
                gone = gone.unionByName(rest.join(keys, self.key, "left_semi"))
                rest = rest.join(keys, self.key, "left_anti")
        self._change(batch, parts, rest, fresh, gone, count(fresh) if count else {})
        return True

    def delete(self, condition: Column | str, batch: str | None = None) -> bool:
        """Rows that meet the condition go."""
        batch = self._begin(batch)
        if batch is None:
            return False
        meets = F.expr(condition) if isinstance(condition, str) else condition
        parts = {r[0] for r in self._rows().where(meets).select(PART).distinct().collect()}
        stored = self._rows(sorted(parts))
        met = F.coalesce(meets, F.lit(False))
        self._change(batch, parts, stored.where(~met), None, stored.where(met), {})
        return True

    def set_payload(self, changes: DataFrame, batch: str | None = None) -> bool:
        """Columns of ``changes`` (with the key, one row each) into the stored rows it names; others keep theirs."""
        batch = self._begin(batch)
        if batch is None:
            return False
        stage, names = f"{self.path}/staged/{batch}/told", [c for c in changes.columns if c != self.key]
        changes.select(F.col(self.key), F.struct(*names).alias("docloom_new"), self.part(self.key).alias(PART)).write.parquet(stage)
        self._widen(changes.schema)
        told = self.spark.read.parquet(stage)
        parts = {r[0] for r in told.select(PART).distinct().collect()}
        stored = self._rows(sorted(parts))
        joined = stored.join(told.drop(PART), self.key, "left")
        for c in names:
            joined = joined.withColumn(c, F.when(F.col("docloom_new").isNotNull(), F.col(f"docloom_new.{c}")).otherwise(F.col(c)))
        fresh = gone = None
        if self.text in names:
            fresh, gone = joined.where("docloom_new IS NOT NULL").drop("docloom_new"), stored.join(told.select(self.key), self.key, "left_semi")
        self._change(batch, parts, joined.drop("docloom_new").hint("rebalance", PART), fresh, gone, {})
        return True

    def _begin(self, batch: str | None) -> str | None:
        self.recover()
        batch = batch or uuid.uuid4().hex
        return None if self.done(batch) else batch

    def _widen(self, schema: T.StructType) -> None:
        """Columns that the stored rows don't have yet are null there."""
        old = self.schema
        if added := [f for f in schema.fields if f.name not in old.names]:
            self._set(schema=T.StructType(old.fields + [T.StructField(f.name, f.dataType) for f in added]).jsonValue())

    def _write_rows(self, rows: DataFrame, name: str) -> None:
        """Rows with their ``PART`` as files of the stored layout."""
        indexed = [c for c in self.settings["indexes"] if c in rows.columns]
        out = rows.sortWithinPartitions(PART, *indexed, *(c for c in self.settings["sort_by"] if c in rows.columns))
        writer = out.write.option("maxRecordsPerFile", 1_000_000)
        for c in indexed:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.partitionBy(PART).parquet(f"{self.path}/{name}")

    def _parts(self, name: str) -> list[int | None]:
        """The partitions of a folder of the stored layout; None for that of rows without one."""
        found = [n.partition("=")[2] for n in self.files.names(name) if n.startswith(f"{PART}=")]
        return [int(n) if n.lstrip("-").isdigit() else None for n in found]

    def _change(self, batch: str, parts: set[int], rest: DataFrame | None, fresh: DataFrame | None, gone: DataFrame | None, counters: dict) -> None:
        """``rest``: the rows of ``parts`` as they will be, but for those in ``staged/<batch>/new``."""
        stage = f"{self.path}/staged/{batch}"
        old = [f"{PART}={p}/{n}" for p in sorted(parts) for n in self.files.names(f"rows/{PART}={p}")]
        if parts:
            self._write_rows(rest, f"staged/{batch}/rows")
        if self.text and (fresh is not None or gone is not None):
            size = self.files.size(f"staged/{batch}")
            postings.delta(self.key, self.text, fresh, gone, size).write.partitionBy("bucket").parquet(f"{stage}/postings")
        if fresh is not None and (lists := VectorIndex.of(self)):
            lists.write(fresh.select(self.key, lists.column), f"{stage}/lists")
        self.files.write(f"staged/{batch}/plan.json", {"parts": sorted(parts), "old": old, "counters": counters})
        self._publish(batch)

    def recover(self) -> list[str]:
        """Publishes what a writer had sealed when it was interrupted, and drops what it hadn't."""
        found = []
        for batch in self.files.names("staged"):
            if self.files.exists(f"staged/{batch}/plan.json") and not self.done(batch):
                self._publish(batch)
                found.append(batch)
            else:
                self.files.delete(f"staged/{batch}")
        return found

    def _publish(self, batch: str) -> None:
        stage, plan = f"staged/{batch}", self.files.read(f"staged/{batch}/plan.json")
        if "rebuilt" in plan:
            self._swap(stage, plan["rebuilt"])
        if "vectors" in plan:
            self.files.write("vectors.json", plan["vectors"])
        if "old" in plan:
            self._overwrite(stage, plan)
        for name in ("postings", "lists"):
            if self.files.exists(f"{stage}/{name}"):
                self.files.rename(f"{stage}/{name}", f"{name}/batch={batch}")
        self.files.write(f"ledger/{batch}.json", {"batch": batch, **plan["counters"]})
        self.files.delete(stage)

    def _overwrite(self, stage: str, plan: dict) -> None:
        """The files of ``plan["old"]`` go, the staged ones take their places. What has been done already isn't found again."""
        for name in plan["old"]:
            self.files.delete(f"rows/{name}")
        parts = set(plan["parts"])
        for folder in (f"{stage}/rows", f"{stage}/new"):
            for part in self._parts(folder):
                parts.add(part)
                for name in self.files.names(f"{folder}/{PART}={part}"):
                    self.files.rename(f"{folder}/{PART}={part}/{name}", f"rows/{PART}={part}/{name}")
        empty = {p for p in parts if not self.files.names(f"rows/{PART}={p}")}
        for part in empty:  # nothing of it is left
            for folder in ("rows", *(f"index/{c}" for c in self.settings["indexes"])):
                self.files.delete(f"{folder}/{PART}={part}")
        for c in self.settings["indexes"]:
            if c in self.schema.names and parts - empty:
                self._write_index(c, self._rows(sorted(parts - empty)))

    # ---- the inverted index

    def postings(self) -> DataFrame:
        if not self.text:
            raise ValueError("a collection without an inverted index")
        if not self.files.exists("postings"):
            return self.spark.createDataFrame([], postings.SCHEMA)
        return self.spark.read.schema(postings.SCHEMA).parquet(f"{self.path}/postings")

    def compact(self) -> None:
        """The additions of all batches to the inverted index as one."""
        self.recover()
        if self.files.exists("postings"):
            self.rebuild("postings", lambda folder: postings.write(postings.netted(self.postings()), folder))

    def rebuild(self, name: str, write: Callable[[str], None], **plan) -> None:
        """``write`` makes an index anew in the folder it is given, which then takes the place of the old one."""
        batch = f"{name}-{uuid.uuid4().hex}"
        write(f"{self.path}/staged/{batch}/rebuilt")
        self.files.write(f"staged/{batch}/plan.json", {"parts": [], "counters": {}, "rebuilt": name, **plan})
        self._publish(batch)

    def _swap(self, stage: str, name: str) -> None:
        """A rebuilt index in place of all batches of the old one."""
        if self.files.exists(f"{stage}/rebuilt"):
            self.files.delete(name)
            self.files.rename(f"{stage}/rebuilt", f"{name}/batch={stage.rpartition('/')[2]}")


def _looked_up(values: DataFrame) -> DataFrame:
    """Distinct values to look rows up by: broadcast up to ``BROADCAST_KEYS``."""
    return F.broadcast(values) if values.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else values


def _with_part(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PART, T.LongType())])


def merge_rows(old: DataFrame | None, new: DataFrame, key: str, order: Column | None = None, replace: str | None = None) -> DataFrame:
    """``new`` and the rows of ``old`` that it doesn't replace."""
    if order is not None:
        new = new.withColumn("docloom_n", F.row_number().over(Window.partitionBy(key).orderBy(order.desc()))).where("docloom_n = 1").drop("docloom_n")
    else:
        new = new.dropDuplicates([key])
    if old is None:
        return new
    rest = old.join(new.select(replace or key).distinct(), replace or key, "left_anti")
    return new.unionByName(rest, allowMissingColumns=True)
