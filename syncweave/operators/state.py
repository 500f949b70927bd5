"""Keyed state tables as transforms: upsert, patch, delete and reset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAPPING_KEY = ("year", "source_key")
#: What an upsert of the mapping replaces; base_id and cr_time stay as first written.
MAPPING_UPDATES = ("partition_no", "table_id", "record_id", "checksum", "u_time")


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], update: Sequence[str] | None = None) -> DataFrame:
    """Old rows, with ``update`` columns taken from new rows of the same key, and new rows of new keys.

    One full outer join; no row order matters and a repeated upsert changes nothing.
    """
    rest = [c for c in old.columns if c not in key]
    update = rest if update is None else update
    fresh = new.select(*key, *[F.col(c).alias(f"_n_{c}") for c in rest if c in new.columns], F.lit(True).alias("_new"))
    joined = old.withColumn("_old", F.lit(True)).join(fresh, list(key), "full_outer")

    def pick(c: str):
        if c not in rest or c not in new.columns:
            return F.col(c)
        if c in update:
            return F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c)

    return joined.select(*[pick(c) for c in old.columns])


def upsert_mapping(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, MAPPING_KEY, [c for c in MAPPING_UPDATES if c in old.columns])


def patch(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """An upsert in which a null of the new row keeps the old value."""
    rest = [c for c in old.columns if c not in key]
    fresh = new.select(*key, *[F.col(c).alias(f"_n_{c}") for c in rest if c in new.columns])
    joined = old.join(fresh, list(key), "full_outer")
    return joined.select(*[F.coalesce(f"_n_{c}", c).alias(c) if c in rest and c in new.columns else F.col(c) for c in old.columns])


def delete_years(table: DataFrame, *years: int) -> DataFrame:
    return table.where(~F.coalesce(F.col("year").isin(*years), F.lit(False))) if years else table


def delete_partitions(mapping: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of gone(year, partition_no) removed; an empty list removes nothing."""
    return mapping.join(F.broadcast(gone.select("year", "partition_no")), ["year", "partition_no"], "left_anti")


def reset_partitions(partitions: DataFrame, year: int) -> DataFrame:
    """A year's fill pointers at zero and boundaries empty; its tables stay."""
    here = F.col("year") == year
    cols = {"fill_count": F.when(here, 0).otherwise(F.col("fill_count")).cast(partitions.schema["fill_count"].dataType)}
    cols |= {c: F.when(~here, F.col(c)) for c in partitions.columns if c.startswith(("first_", "last_"))}
    return partitions.withColumns(cols)


def update_boundaries(partitions: DataFrame, found: DataFrame) -> DataFrame:
    """First and last record patched in from packing.boundaries; null leaves what is there."""
    return patch(partitions, found.select("year", "partition_no", *[c for c in found.columns if c in partitions.columns and c not in ("year", "partition_no")]), ("year", "partition_no"))


def set_fill(partitions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fill pointers recomputed as the rows that are mapped."""
    n = mapping.groupBy("year", "partition_no").agg(F.count("*").alias("_n"))
    kind = partitions.schema["fill_count"].dataType
    return partitions.join(n, ["year", "partition_no"], "left").withColumn("fill_count", F.coalesce("_n", F.lit(0)).cast(kind)).select(*partitions.columns)


# ---- state by scope ---------------------------------------------------------------------------------

STATE = "scope string, last_utime string, last_id long, checkpoint string, last_run_at string, status string"


def get_state(states: DataFrame, *scopes: str) -> DataFrame:
    return states.where(F.col("scope").isin(*scopes))


def set_state(states: DataFrame, new: DataFrame) -> DataFrame:
    """New rows of scopes patched in: a null keeps what is there."""
    return patch(states, new, ["scope"])


def clear_state(states: DataFrame, *scopes: str) -> DataFrame:
    """Rows of the scopes removed, as a patch cannot make a field null."""
    return states.where(~F.col("scope").isin(*scopes))


def last_partition(states: DataFrame, scope: str) -> DataFrame:
    """(scope, after): the partition at which a walk's checkpoint stands."""
    return get_state(states, scope).select("scope", F.coalesce(F.get_json_object("checkpoint", "$.lastPartitionNo").try_cast("int"), F.lit(0)).alias("after"))


def walk(partitions: DataFrame, after: int, budget: int | None) -> DataFrame:
    """The next partitions in order after a checkpoint, at most ``budget`` of them."""
    rest = partitions.where(F.col("partition_no") > after)
    return rest if budget is None else rest.orderBy("partition_no").limit(budget)
