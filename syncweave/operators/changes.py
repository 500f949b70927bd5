"""Routing of changed rows: insert, update, skip or ignore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncweave.functions import eras


def ready_years(years: DataFrame) -> DataFrame:
    """years(year, base_id, status) that take rows; the registry has one row a year."""
    return years.where(F.col("status") == "complete").select("year", "base_id")


def split_ready(rows: DataFrame, years: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ready years with base_id, rows that are ignored); rows need ``year``, nulls are ignored."""
    ready = F.broadcast(ready_years(years))
    return rows.join(ready, "year"), rows.join(ready.select("year"), "year", "left_anti")


def action(mapped_key: Column, mapped: Column, current: Column) -> Column:
    return F.when(mapped_key.isNull(), "insert").when(~mapped.eqNullSafe(current), "update").otherwise("skip")


def classify(rows: DataFrame, mapping: DataFrame, years: DataFrame) -> DataFrame:
    """rows(year, source_key, checksum, ...) with ``action`` and the mapped partition, table and record.

    One left join on (year, source_key); the year registry is the only broadcast side.
    """
    known = mapping.select("year", "source_key", F.col("source_key").alias("_k"), F.col("checksum").alias("_c"), "partition_no", "table_id", "record_id")
    ready = F.broadcast(ready_years(years))
    joined = rows.join(known, ["year", "source_key"], "left").join(ready, "year", "left")
    found = F.when(F.col("base_id").isNull(), "ignore").otherwise(action(F.col("_k"), F.col("_c"), F.col("checksum")))
    return joined.withColumn("action", found).drop("_k", "_c")


def counters(classified: DataFrame) -> DataFrame:
    """scanned, inserted, updated, skipped, ignored_rows and ignored_years in one pass."""
    n = lambda a: F.count_if(F.col("action") == a)
    return classified.agg(
        F.count("*").alias("scanned"),
        n("insert").alias("inserted"),
        n("update").alias("updated"),
        n("skip").alias("skipped"),
        n("ignore").alias("ignored_rows"),
        F.array_sort(F.collect_set(F.when(F.col("action") == "ignore", F.col("year")))).alias("ignored_years"),
    )


def next_watermark(rows: DataFrame, since: str) -> DataFrame:
    """The largest update time in the Common Era, cut to the second; the old watermark when nothing came."""
    return rows.agg(F.coalesce(eras.watermark(F.max("UTime")), F.lit(since)).alias("new_watermark"))


def batch_ordinals(rows: DataFrame, order: list[str], size: int = 1000, by: str = "year") -> DataFrame:
    """``rn`` and the number of the write batch within each year."""
    from syncweave.operators.packing import number_rows

    return number_rows(rows, order, by).withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("long"))
