"""Partitions that should exist, do exist, or go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncweave.functions.names import PER_YEAR, parse_partition_no, partition_name


def wanted(spark: SparkSession, count: int = PER_YEAR) -> DataFrame:
    no = F.col("id").cast("int")
    return spark.range(1, count + 1).select(no.alias("partition_no"), partition_name(no).alias("name"))


def to_create(existing: DataFrame, count: int = PER_YEAR) -> DataFrame:
    """Partitions 1..count that existing(name) lacks; names that fit no pattern are not looked at."""
    have = existing.select(parse_partition_no(F.col("name")).alias("partition_no")).where("partition_no is not null").distinct()
    return wanted(existing.sparkSession, count).join(have, "partition_no", "left_anti")


def in_range(existing: DataFrame, count: int = PER_YEAR) -> DataFrame:
    no = parse_partition_no(F.col("name"))
    return existing.withColumn("partition_no", no).where(no.between(1, count))


def removable(existing: DataFrame, count: int = PER_YEAR) -> DataFrame:
    """What a removal drops: the same range as provisioning looks at."""
    return in_range(existing, count)


def provision_status(existing: DataFrame, count: int = PER_YEAR, budget: int | None = None) -> DataFrame:
    """existing, created (within the budget of table creations) and remaining counts, and the year's status."""
    here = in_range(existing, count).select("partition_no").distinct()
    n = here.agg(F.count("*").alias("existing"))
    made = (F.lit(count) - F.col("existing")) if budget is None else F.least(F.lit(budget), F.lit(count) - F.col("existing"))
    rows = n.withColumn("created", made.cast("long")).withColumn("remaining", (F.lit(count) - F.col("existing") - F.col("created")).cast("long"))
    return rows.withColumn("status", F.when(F.col("remaining") == 0, "complete").otherwise("partial"))


def base_status(years: DataFrame, partitions: DataFrame, count: int = PER_YEAR) -> DataFrame:
    """Each year's existing and missing partitions and whether it is complete."""
    n = partitions.where(F.col("partition_no").between(1, count)).groupBy("year").agg(F.count_distinct("partition_no").alias("existing"))
    rows = years.join(n, "year", "left").withColumn("existing", F.coalesce("existing", F.lit(0)))
    return rows.withColumn("missing", (F.lit(count) - F.col("existing")).cast("long")).withColumn("complete", F.col("missing") == 0)
