"""The target as a table (year, table_id, record_id, ...) and its reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_ids(target: DataFrame, table_id: str | None = None) -> DataFrame:
    rows = target if table_id is None else target.where(F.col("table_id") == table_id)
    return rows.select("table_id", "record_id")


def count_records(target: DataFrame) -> DataFrame:
    return target.groupBy("table_id").agg(F.count("*").alias("n_target"))


def list_tables(target_tables: DataFrame) -> DataFrame:
    return target_tables.select("table_id", "name").orderBy("name", "table_id")


def create_records(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds records; those whose id is there already stay as they are."""
    return target.unionByName(rows.join(target.select("table_id", "record_id"), ["table_id", "record_id"], "left_anti"), allowMissingColumns=True)


def update_records(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Overwrites the fields that rows carry for records that exist."""
    keys = ["table_id", "record_id"]
    fields = [c for c in rows.columns if c not in keys and c in target.columns]
    new = rows.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in fields], F.lit(True).alias("_hit"))
    joined = target.join(new, keys, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in target.columns])


def delete_records(target: DataFrame, ids: DataFrame) -> DataFrame:
    return target.join(ids.select("table_id", "record_id"), ["table_id", "record_id"], "left_anti")
