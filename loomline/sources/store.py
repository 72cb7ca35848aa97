"""A keyed store of rows on files: updates, upserts and deletes are written as small deltas and merged when read.

    store/manifest/00000012.json   what a version consists of: its base, its deltas in order, the streams' last batches
    store/base-..                  one row a key, bucketed and sorted by key
    store/delta-..                 one batch: operation, columns it sets, values, bucketed and sorted by key

A batch writes its own delta and a manifest, and touches no other file. A reader opens the newest manifest, folds the
deltas to one row a key, in the order of their batches, and joins that to the base bucket by bucket, so the base isn't
shuffled. compact() writes the merged rows as a new base. Manifests are created under numbers that no one has taken yet:
of two writers one gets the number, and the other reads what came before and tries the next one.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUT, PATCH, DELETE = "put", "patch", "delete"
TRIES = 20


class KeyedStore:
    """Rows told by one column. Rows without a key aren't taken. Open an existing store by its path; create() makes one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        now = self.manifest()
        if now is None:
            raise FileNotFoundError(f"no store at {path}")
        self.key, self.buckets, self.schema = now["key"], now["buckets"], T.StructType.fromJson(now["schema"])

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType | str, key: str, buckets: int = 64) -> KeyedStore:
        made = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        first = {"version": 0, "key": key, "buckets": buckets, "schema": made.jsonValue(), "base": None, "deltas": [], "batches": {}}
        cls._put_text(spark, f"{path.rstrip('/')}/manifest/{0:012d}.json", json.dumps(first))
        return cls(spark, path)

    # ---- manifests

    @staticmethod
    def _at(spark: SparkSession, path: str):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place

    @classmethod
    def _put_text(cls, spark: SparkSession, path: str, text: str) -> None:
        """A whole file that wasn't there: written beside and renamed, which fails where the name is taken."""
        fs, place = cls._at(spark, path)
        _, beside = cls._at(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = fs.create(beside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(place) or not fs.rename(beside, place):
            fs.delete(beside, False)
            raise FileExistsError(path)

    def _numbers(self) -> list[int]:
        fs, place = self._at(self.spark, f"{self.path}/manifest")
        if not fs.exists(place):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest version's content, or that of an older one."""
        numbers = self._numbers()
        if not numbers:
            return None
        fs, place = self._at(self.spark, f"{self.path}/manifest/{numbers[-1] if version is None else version:012d}.json")
        opened = fs.open(place)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
        finally:
            opened.close()

    def _commit(self, change) -> bool:
        """change(manifest) -> the next one's content, or None to leave all as it is. Another writer's version is read and the change tried again."""
        for _ in range(TRIES):
            now = self.manifest()
            new = change(dict(now))
            if new is None:
                return False
            new["version"] = now["version"] + 1
            try:
                self._put_text(self.spark, f"{self.path}/manifest/{new['version']:012d}.json", json.dumps(new))
                return True
            except FileExistsError:
                continue
        raise RuntimeError(f"no free version after {TRIES} tries")

    # ---- files

    def _table(self, folder: str, schema: T.StructType) -> str:
        """The catalog's name of a folder of bucketed files; a session that hasn't seen it registers it."""
        name = f"store_{hashlib.md5(self.path.encode()).hexdigest()[:12]}_{folder.replace('-', '_')}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"create table if not exists {name} ({columns}) using parquet clustered by (`{self.key}`) sorted by (`{self.key}`) into {self.buckets} buckets location '{self.path}/{folder}'")
        return name

    def _write(self, df: DataFrame, folder: str) -> None:
        name = f"store_{uuid.uuid4().hex}"
        dealt = df.repartition(self.buckets, F.col(f"`{self.key}`"))
        dealt.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", f"{self.path}/{folder}").saveAsTable(name)
        self.spark.sql(f"drop table {name}")  # the files stay

    def _delta_schema(self) -> T.StructType:
        return T.StructType([T.StructField("_op", T.StringType()), T.StructField("_set", T.ArrayType(T.StringType())), *(T.StructField(f.name, f.dataType) for f in self.schema)])

    def _add(self, op: str, df: DataFrame, columns: Sequence[str], order: Column | str | None, stream: str | None, batch: int | None) -> bool:
        if stream is not None and self.manifest()["batches"].get(stream, -1) >= batch:
            return False
        own = {f.name: (F.col(f"`{f.name}`").cast(f.dataType) if f.name in columns or f.name == self.key else F.lit(None).cast(f.dataType)).alias(f.name) for f in self.schema}
        rows = df.where(F.col(f"`{self.key}`").isNotNull())
        sets = F.array(*(F.lit(c) for c in columns)).cast("array<string>")
        last = F.struct(F.lit(0)) if order is None else F.struct(F.col(order) if isinstance(order, str) else order)
        row = F.struct(F.lit(op).alias("_op"), sets.alias("_set"), *own.values())
        # of a batch's rows for one key the last by `order` counts, then the greatest
        kept = rows.select(F.col(f"`{self.key}`").alias("_key"), last.alias("_order"), row.alias("_row")).groupBy("_key").agg(F.max_by("_row", F.struct("_order", F.to_json("_row"))).alias("_row"))
        folder = f"delta-{uuid.uuid4().hex}"
        self._write(kept.select("_row.*"), folder)

        def change(m: dict) -> dict | None:
            if stream is not None:
                if m["batches"].get(stream, -1) >= batch:
                    return None
                m["batches"] = m["batches"] | {stream: batch}
            return m | {"deltas": [*m["deltas"], folder]}

        done = self._commit(change)
        if not done:
            self._drop(folder)
        return done

    def _drop(self, folder: str) -> None:
        fs, place = self._at(self.spark, f"{self.path}/{folder}")
        fs.delete(place, True)

    # ---- operations

    def put(self, df: DataFrame, order: Column | str | None = None, stream: str | None = None, batch: int | None = None) -> bool:
        """Rows that take the place of those with their keys; columns that df lacks become null. stream, batch: a batch of a stream that is already in changes nothing (False)."""
        return self._add(PUT, df, [f.name for f in self.schema if f.name in df.columns], order, stream, batch)

    def patch(self, df: DataFrame, order: Column | str | None = None, stream: str | None = None, batch: int | None = None) -> bool:
        """The columns that df has are set in the rows that are there; keys that aren't there stay away."""
        return self._add(PATCH, df, [f.name for f in self.schema if f.name in df.columns and f.name != self.key], order, stream, batch)

    def delete(self, keys: DataFrame, stream: str | None = None, batch: int | None = None) -> bool:
        """The rows with these keys go."""
        return self._add(DELETE, keys, [], None, stream, batch)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as they are now, or as they were at an older version whose files are still there."""
        return self._merged(self.manifest(version))

    def _merged(self, now: dict) -> DataFrame:
        names = [f.name for f in self.schema]
        key = F.col(f"`{self.key}`")
        base = self.spark.table(self._table(now["base"], self.schema)) if now["base"] else self.spark.createDataFrame([], self.schema)
        if not now["deltas"]:
            return base
        events = None
        for n, folder in enumerate(now["deltas"]):
            rows = self.spark.table(self._table(folder, self._delta_schema())).withColumn("_n", F.lit(n))
            events = rows if events is None else events.unionAll(rows)
        whole = F.col("_op") != PATCH
        # a put sets every column, so the last event that sets one is never older than the last put; what came before a
        # delete is cut off by its number
        sets = lambda c: (F.col("_op") == PUT) | F.array_contains("_set", c)
        last = events.groupBy(key.alias("_key")).agg(
            F.max_by("_op", F.when(whole, F.col("_n"))).alias("_last"), F.max(F.when(F.col("_op") == DELETE, F.col("_n"))).alias("_gone"),
            *(F.max_by(F.struct("_n", F.col(f"`{c}`").alias("v")), F.when(sets(c), F.col("_n"))).alias(f"_{i}") for i, c in enumerate(names) if c != self.key),
        )
        both = base.select(key.alias("_base"), *(F.col(f"`{c}`").alias(f"b{i}") for i, c in enumerate(names))).join(last, F.col("_base") == F.col("_key"), "full")
        alive = F.when(F.col("_last").isNotNull(), F.col("_last") == PUT).otherwise(F.col("_base").isNotNull())
        fresh = lambda i: F.col(f"_{i}").isNotNull() & (F.col("_gone").isNull() | (F.col(f"_{i}._n") > F.col("_gone")))
        values = [F.coalesce("_base", "_key").alias(c) if c == self.key else F.when(fresh(i), F.col(f"_{i}.v")).otherwise(F.when(F.col("_last").isNull(), F.col(f"b{i}"))).alias(c) for i, c in enumerate(names)]
        return both.where(alive).select(*values)

    def compact(self) -> bool:
        """A new base of the merged rows; deltas that come meanwhile stay. False if there is nothing to merge."""
        then = self.manifest()
        if not then["deltas"]:
            return False
        folder = f"base-{uuid.uuid4().hex}"
        self._write(self._merged(then), folder)

        def change(m: dict) -> dict | None:
            if m["base"] != then["base"] or m["deltas"][: len(then["deltas"])] != then["deltas"]:
                return None  # another compaction was quicker
            return m | {"base": folder, "deltas": m["deltas"][len(then["deltas"]) :]}

        done = self._commit(change)
        if not done:
            self._drop(folder)
        return done

    def vacuum(self, keep: int = 1) -> int:
        """Deletes older versions' manifests, all but the last `keep`, and the folders that no kept version names; returns how many of these. Not while others write."""
        numbers = self._numbers()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        used = {f for m in kept for f in (m["base"], *m["deltas"]) if f}
        fs, place = self._at(self.spark, self.path)
        old = [s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName().startswith(("base-", "delta-")) and s.getPath().getName() not in used]
        for n in numbers[:-keep]:
            fs.delete(self._at(self.spark, f"{self.path}/manifest/{n:012d}.json")[1], False)
        for folder in old:
            self.spark.sql(f"drop table if exists store_{hashlib.md5(self.path.encode()).hexdigest()[:12]}_{folder.replace('-', '_')}")
            self._drop(folder)
        return len(old)
