"""Packing of new rows into partitions of fixed capacity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from syncweave.storage import checkpointed

def number_rows(rows: DataFrame, order: list[str], by: str = "year", wide: bool = False) -> DataFrame:
    """``rn``: 1.. in the given total order within each year.

    ``wide`` is for years that no task should sort alone: rows are dealt by ranges of (year, order), written
    once so that the ranges hold still, numbered inside a range, and moved up by what the year's earlier
    ranges hold.  Equal leading columns do no harm, as the whole order makes the ranges.
    """
    if not wide:
        return rows.withColumn("rn", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    ranged = checkpointed(rows.repartitionByRange(by, *order).withColumn("_b", F.spark_partition_id()))
    held = ranged.groupBy(by, "_b").agg(F.count("*").alias("_n"))
    before = held.select(by, "_b", (F.sum("_n").over(Window.partitionBy(by).orderBy("_b")) - F.col("_n")).alias("_before"))
    inside = ranged.withColumn("_i", F.row_number().over(Window.partitionBy(by, "_b").orderBy(*order)))
    return inside.join(before, [by, "_b"]).withColumn("rn", (F.col("_before") + F.col("_i")).cast("int")).drop("_b", "_before", "_i")


def segments(partitions: DataFrame, need: DataFrame, capacity: int) -> DataFrame:
    """partitions(year, partition_no, table_id, fill_count), need(year, need) -> the segments that are taken.

    Open partitions are filled in order: a running sum of free room gives each its part.
    """
    free = F.lit(capacity) - F.col("fill_count")
    rooms = partitions.where(F.col("fill_count") < capacity).withColumn("hi", F.sum(free).over(Window.partitionBy("year").orderBy("partition_no"))).withColumn("lo", F.col("hi") - free)
    return (
        rooms.join(need, "year")
        .where(F.col("lo") < F.col("need"))
        .select(
            "year",
            "partition_no",
            "table_id",
            F.col("fill_count").cast("long").alias("start_index"),
            F.least(free, F.col("need") - F.col("lo")).cast("long").alias("count"),
            F.col("lo").cast("long").alias("offset"),
        )
    )


def shortfalls(partitions: DataFrame, need: DataFrame, capacity: int) -> DataFrame:
    """Years whose open partitions cannot take all their rows, and by how many rows."""
    room = partitions.groupBy("year").agg(F.sum(F.greatest(F.lit(0), F.lit(capacity) - F.col("fill_count"))).alias("room"))
    return need.join(room, "year", "left").withColumn("missing", (F.col("need") - F.coalesce("room", F.lit(0))).cast("long")).where("missing > 0").select("year", "need", "missing")


def assign_slots(numbered: DataFrame, taken: DataFrame) -> DataFrame:
    """numbered(year, rn, ...) with partition_no, table_id and slot; at most some hundred segments a year are broadcast."""
    s = F.broadcast(taken.select(F.col("year").alias("_y"), "partition_no", "table_id", "start_index", "count", "offset"))
    inside = (F.col("year") == F.col("_y")) & (F.col("rn") - 1 >= F.col("offset")) & (F.col("rn") - 1 < F.col("offset") + F.col("count"))
    return numbered.join(s, inside).withColumn("slot", (F.col("start_index") + F.col("rn") - 1 - F.col("offset")).cast("long")).drop("_y", "start_index", "count", "offset")


def boundaries(assigned: DataFrame) -> DataFrame:
    """First (only where slot 0 was taken) and last record of every partition that got rows."""
    return assigned.groupBy("year", "partition_no").agg(
        F.min_by(F.when(F.col("slot") == 0, F.col("source_key")), F.col("slot")).alias("first_source_key"),
        F.max_by("source_key", "slot").alias("last_source_key"),
        F.max("slot").alias("last_slot"),
    )


def open_partition(partitions: DataFrame, capacity: int) -> DataFrame:
    """The lowest partition of each year that has room."""
    room = partitions.where(F.col("fill_count") < capacity)
    return room.groupBy("year").agg(F.min_by(F.struct("partition_no", "table_id", "fill_count"), "partition_no").alias("p")).select("year", "p.*")


def correct_fill(partitions: DataFrame, counted: DataFrame, capacity: int) -> DataFrame:
    """The open partition's fill pointer moved down, never up, to the records that are there."""
    open_no = open_partition(partitions, capacity).select("year", F.col("partition_no").alias("_open"))
    joined = partitions.join(F.broadcast(open_no), "year", "left").join(counted.select("table_id", "n_target"), "table_id", "left")
    fixed = F.when(F.col("partition_no") == F.col("_open"), F.least(F.col("fill_count"), F.coalesce("n_target", F.lit(0)))).otherwise(F.col("fill_count"))
    return joined.withColumn("fill_count", fixed.cast("long")).select(*partitions.columns)
