"""Reliable checkpoints in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where none is set, a temporary one in local mode, else an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not context.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return (named or context._jsc.sc().getCheckpointDir().get()).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, without their lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
