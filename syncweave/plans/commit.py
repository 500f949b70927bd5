"""Durable commits of a store: a folder of versions with a pointer that is written last.

Tables of many rows are laid out by year and version; a commit writes the years that a run has touched and the
small tables, and only then the pointer, which names the version of every year and carries the watermark.  A run
that breaks off before the pointer leaves the last commit as it was, and its repeat overwrites what it had begun.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncweave.operators.state import STATE
from syncweave.plans.incremental import Store

BY_YEAR, SMALL = ("mapping", "target"), ("partitions", "years", "jobs", "states")


def _versioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("v", T.LongType())])


class StateFolder:
    """Versions of the store under one path that all executors share; one driver commits."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _pointers(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("version long, watermark string, tables string").json(f"{self.path}/versions/*")
        except Exception as e:  # the folder's first use
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def _latest(self) -> tuple[int, str | None, dict]:
        found = self._pointers()
        row = None if found is None else found.agg(F.max_by(F.struct("version", "watermark", "tables"), "version").alias("m")).first().m
        return (-1, None, {}) if row is None else (row.version, row.watermark, json.loads(row.tables))

    def latest(self) -> tuple[int, str | None]:
        return self._latest()[:2]

    def load(self, gateway=None) -> Store:
        version, mark, tables = self._latest()
        if version < 0:
            raise FileNotFoundError(f"{self.path} holds no commit")
        frames = {}
        for t in BY_YEAR:
            kind, years = T.StructType.fromJson(tables[t]["schema"]), tables[t]["years"]
            paths = [f"{self.path}/{t}/year={y}/v={v}" for y, v in years.items()]
            read = self.spark.read.schema(_versioned(kind)).option("basePath", f"{self.path}/{t}")
            frames[t] = read.parquet(*paths).select(*kind.fieldNames()) if paths else self.spark.createDataFrame([], kind)
        for t in SMALL:
            frames[t] = self.spark.read.schema(T.StructType.fromJson(tables[t]["schema"])).parquet(f"{self.path}/{t}/v{version}") if t in tables else None
        return Store(frames["mapping"], frames["partitions"], frames["years"], frames["target"], mark, frames["jobs"], frames["states"], gateway)

    def save(self, store: Store, version: int) -> None:
        """Commits as a version; store.touched are the years that differ from the last one (None: all)."""
        before = self._latest()[2]
        tables: dict[str, dict] = {}
        for t in BY_YEAR:
            df = getattr(store, t)
            known = before.get(t, {}).get("years", {})
            kind = json.loads(df.schema.json())
            same = before and T.StructType.fromJson(before[t]["schema"]).simpleString() == df.schema.simpleString()
            whole = store.touched is None or not same
            rows = df if whole else df.where(F.col("year").isin(*store.touched)) if store.touched else df.limit(0)
            path = f"{self.path}/{t}"
            rows.withColumn("v", F.lit(version)).repartition("year", "table_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "v").parquet(path)
            there = self.spark.read.schema(_versioned(df.schema)).parquet(path).where(F.col("v") == version).select("year").distinct().collect()  # a row a year
            kept = {} if whole else {y: v for y, v in known.items() if int(y) not in store.touched}
            tables[t] = {"schema": kind, "years": kept | {str(r.year): version for r in there}}
        for t in SMALL:
            df = getattr(store, t)
            if df is not None:
                df.write.mode("overwrite").parquet(f"{self.path}/{t}/v{version}")
                tables[t] = {"schema": json.loads(df.schema.json())}
        pointer = self.spark.createDataFrame([(version, store.watermark, json.dumps(tables))], "version long, watermark string, tables string")
        pointer.coalesce(1).write.mode("overwrite").json(f"{self.path}/versions/v{version}")

    def commit(self, store: Store) -> Store:
        """The store as read back from a new version; its plans start at the files."""
        self.save(store, self.latest()[0] + 1)
        self.prune()
        return self.load(store.gateway)

    def prune(self, keep: int = 2) -> None:
        """Removes files that none of the last commits names."""
        found = self._pointers()
        if found is None:
            return
        rows = found.orderBy(F.desc("version")).limit(keep).collect()
        last = min(r.version for r in rows)
        used = {t: {f"year={y}/v={v}" for r in rows for y, v in json.loads(r.tables)[t]["years"].items()} for t in BY_YEAR}
        for t in BY_YEAR:
            for year in self._names(t):
                for v in self._names(f"{t}/{year}"):
                    if year.startswith("year=") and f"{year}/{v}" not in used[t] and int(v.split("=")[1]) <= rows[0].version:
                        self._remove(f"{t}/{year}/{v}")
        for t in (*SMALL, "versions"):
            for v in self._names(t):
                if int(v.removeprefix("v")) < last:
                    self._remove(f"{t}/{v}")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, fs = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []

    def _remove(self, name: str) -> None:
        path, fs = self._at(name)
        fs.delete(path, True)


def empty_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def with_state(store: Store, scope: str, **fields: object) -> Store:
    """The store with a scope's fields patched in."""
    from syncweave.operators.state import set_state

    states = store.states if store.states is not None else empty_states(store.mapping.sparkSession)
    values = [(scope, *[fields.get(f.name) for f in states.schema.fields[1:]])]
    return replace(store, states=set_state(states, states.sparkSession.createDataFrame(values, states.schema)))
