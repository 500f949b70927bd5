"""Checks of counts, and identity differences between source, mapping and target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drift_status(target: Column, mapped: Column, fill: Column, label: str = "target_drift") -> Column:
    """``label`` where target and mapping differ, before any difference of the fill pointer."""
    return F.when(target != mapped, label).when(fill != mapped, "fill_count_drift").otherwise("ok")


def check_partitions(partitions: DataFrame, mapping: DataFrame, target: DataFrame, after: int = 0) -> DataFrame:
    """Counts of each partition in mapping and target, with its status; both sides are aggregated before the join."""
    mapped = mapping.groupBy("year", "partition_no").agg(F.count("*").alias("n_mapped"))
    there = target.groupBy("table_id").agg(F.count("*").alias("n_target"))
    rows = partitions.where(F.col("partition_no") > after).join(mapped, ["year", "partition_no"], "left").join(there, "table_id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_mapped", "n_target")})
    status = drift_status(F.col("n_target"), F.col("n_mapped"), F.col("fill_count"))
    return rows.select("year", "partition_no", "table_id", F.col("fill_count").cast("long").alias("fill_count"), "n_mapped", "n_target", status.alias("status"))


def check_summary(checked: DataFrame, source_counts: DataFrame) -> DataFrame:
    """Totals of each year and whether its backfill is incomplete; source_counts(year, n_source)."""
    sums = checked.groupBy("year").agg(
        F.count("*").alias("partitions_checked"),
        F.sum("n_mapped").alias("mapped_total"),
        F.sum("n_target").alias("target_total"),
        F.count_if(F.col("status") != "ok").alias("findings"),
    )
    joined = sums.join(source_counts, "year", "left").withColumn("n_source", F.coalesce("n_source", F.lit(0)))
    return joined.withColumn("backfill_incomplete", F.col("mapped_total") < F.col("n_source"))


def orphans(target: DataFrame, mapping: DataFrame) -> DataFrame:
    """Target records that no mapping names."""
    return target.join(mapping.select("table_id", "record_id"), ["table_id", "record_id"], "left_anti")


def missing(mapping: DataFrame, target: DataFrame) -> DataFrame:
    """Mappings whose record is gone from the target."""
    return mapping.join(target.select("table_id", "record_id"), ["table_id", "record_id"], "left_anti")


def recreate(missing_rows: DataFrame, source: DataFrame) -> DataFrame:
    """Missing mappings whose source row still exists; source(source_key, ...)."""
    return missing_rows.join(source.select("source_key").distinct(), "source_key", "left_semi")


def unrecoverable(missing_rows: DataFrame, source: DataFrame) -> DataFrame:
    return missing_rows.join(source.select("source_key").distinct(), "source_key", "left_anti")


def heal_actions(partitions: DataFrame, mapping: DataFrame, target: DataFrame, source: DataFrame) -> DataFrame:
    """Orphans deleted and records recreated by partition, only where something is done."""
    gone = orphans(target, mapping).groupBy("table_id").agg(F.count("*").alias("orphans_deleted"))
    lost = missing(mapping, target)
    back = recreate(lost, source).groupBy("table_id").agg(F.count("*").alias("recreated"))
    rows = partitions.select("year", "partition_no", "table_id").join(gone, "table_id", "left").join(back, "table_id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("orphans_deleted", "recreated")})
    return rows.where("orphans_deleted > 0 or recreated > 0")


def deleted_in_source(mapping: DataFrame, source: DataFrame) -> DataFrame:
    return mapping.join(source.select("source_key").distinct(), "source_key", "left_anti")


def source_drift(source: DataFrame, mapping: DataFrame) -> DataFrame:
    """Keys whose fingerprint in the source differs from the mapping's; source(year, source_key, checksum)."""
    known = mapping.select("year", "source_key", F.col("checksum").alias("mapped_checksum"))
    return source.select("year", "source_key", "checksum").join(known, ["year", "source_key"]).where(~F.col("checksum").eqNullSafe(F.col("mapped_checksum")))
