"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where none is set, a temporary one in local mode, else an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return (named or context._jsc.sc().getCheckpointDir().get()).rstrip("/")


@contextmanager
def _shuffles_go(spark: SparkSession):
    """Shuffle files of what is run inside go as soon as it has ended, not when the driver's garbage is collected."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def materialise(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a table written to the shared folder, which outlives the executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    with _shuffles_go(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that materialise() wrote; frames that read them can't be run any more."""
    for df in tables:
        if path := _PATHS.pop(df, None):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """An aggregate dealt out once more, so that both sides of a join with it are plain shuffles and a hot key's rows can be split."""
    return df.repartition(F.xxhash64(key))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of df is called so."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        out.append(n)
        have.add(n.lower())
    return out
