"""The synchronisation tables declared over a star schema: facts, change feed, mapping, partitions, target, queue.

Everything is a plan over the scans, so each query prunes the columns it needs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syncweave.functions import eras
from syncweave.functions.identity import canonical_text, derive_key, record_id
from syncweave.functions.names import partition_name
from syncweave.schema import KEY

CAPACITY = 500
PARTITIONS = 40
NOW = datetime(2026, 7, 10, 12, 0, 0)


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def be_text(ts: Column, millis: bool = False) -> Column:
    tail = F.date_format(ts, "-MM-dd HH:mm:ss.SSS" if millis else "-MM-dd HH:mm:ss")
    return F.concat((F.year(ts) + eras.OFFSET_YEARS).cast("string"), tail)


def fact(spark: SparkSession, d: str) -> DataFrame:
    """History: one row a sales line, from lineitem."""
    li = read(spark, d, "lineitem")
    be = be_text(F.col("l_shipdate"))
    return li.select(
        F.col("l_suppkey").cast("long").alias("SellBranch"),
        F.col("l_orderkey").cast("long").alias("SellID"),
        F.col("l_linenumber").cast("long").alias("RowNo"),
        be.alias("CrTime"),
        be.alias("UTime"),
        F.col("l_partkey").cast("long").alias("part"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("Product"),
        F.col("l_quantity").cast("long").alias("NUMBER"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("SRP"),
        F.col("l_returnflag").alias("Comment"),
    )


def content(*cols: str) -> Column:
    return F.md5(canonical_text([F.col(c) for c in cols]))


def keyed(rows: DataFrame) -> DataFrame:
    """year, source_key and the fingerprint of each row."""
    return rows.withColumns({"year": eras.cr_year(F.col("CrTime")), "source_key": derive_key(*KEY), "checksum": content("CrTime", "SellID", "SellBranch", "Product", "NUMBER", "SRP", "Comment")})


def source(spark: SparkSession, d: str) -> DataFrame:
    """Latest version of every key; part breaks equal times."""
    from syncweave.sources.fact import latest_per_key

    return keyed(latest_per_key(fact(spark, d), tie=("part",)))


def feed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(history, today) of the change feed from events: days up to the 28th, and from the 28th on."""
    ev = read(spark, d, "events")
    ts = F.col("ts")
    rows = ev.select(
        F.lit(1).cast("long").alias("SellBranch"),
        F.col("user_id").cast("long").alias("SellID"),
        (F.col("event_id") % 7).cast("long").alias("RowNo"),
        be_text(ts).alias("CrTime"),
        be_text(ts, millis=True).alias("UTime"),
        F.col("event_id").cast("long").alias("part"),
        F.col("event_type").alias("Product"),
        F.dayofmonth(ts).alias("day"),
    )
    return rows.where("day < 29").drop("day"), rows.where("day >= 28").drop("day")


def mapping(spark: SparkSession, d: str) -> DataFrame:
    """A store of earlier runs: keys of sell ids that 4 does not divide; the content of every fifth has moved on."""
    s = source(spark, d).where(F.col("SellID") % 4 != 0)
    part = (F.col("SellID") % PARTITIONS + 1).cast("int")
    stale = F.when(F.col("SellID") % 5 == 0, F.concat(F.lit("old"), F.col("checksum"))).otherwise(F.col("checksum"))
    return s.select(
        "year",
        F.concat(F.lit("base"), F.col("year").cast("string")).alias("base_id"),
        "source_key",
        part.alias("partition_no"),
        table_of(F.col("year"), part).alias("table_id"),
        record_id(F.col("year"), F.col("source_key")).alias("record_id"),
        stale.alias("checksum"),
        eras.be_to_ce(F.col("CrTime")).alias("cr_time"),
        eras.be_to_ce(F.col("UTime")).alias("u_time"),
    )


def table_of(year: Column, no: Column) -> Column:
    return F.concat_ws("-", F.lit("tbl"), year.cast("string"), no.cast("string"))


def years(spark: SparkSession) -> DataFrame:
    """The registry: 1995 to 2001, of which 1998 is not complete and 2001 is unknown."""
    y = F.col("id").cast("int")
    return spark.range(1995, 2001).select(y.alias("year"), F.concat(F.lit("base"), y.cast("string")).alias("base_id"), F.when(y == 1998, "partial").otherwise("complete").alias("status"))


def partitions(spark: SparkSession) -> DataFrame:
    """PARTITIONS a year; the first ones are full or part-filled."""
    y, n = F.col("year"), F.col("partition_no")
    grid = spark.range(7 * PARTITIONS).select((F.col("id") / PARTITIONS).cast("int").alias("y0"), (F.col("id") % PARTITIONS + 1).cast("int").alias("partition_no"))
    grid = grid.select((F.col("y0") + 1995).alias("year"), "partition_no")
    fill = F.when(n <= 3, CAPACITY).when(n == 4, CAPACITY - 20).when(n % 9 == 0, F.lit(CAPACITY) - n).otherwise(0)
    return grid.select("year", "partition_no", table_of(y, n).alias("table_id"), partition_name(n).alias("name"), fill.cast("long").alias("fill_count"), F.concat(F.lit("f"), n.cast("string")).alias("first_source_key"), F.concat(F.lit("l"), n.cast("string")).alias("last_source_key"))


def target(spark: SparkSession, d: str) -> DataFrame:
    """Records that are there: mapped ones but every 50th sell id, and strays of every 75th."""
    m = mapping(spark, d).withColumn("sell", F.split_part("source_key", F.lit("|"), F.lit(2)).cast("long"))
    there = m.where("sell % 50 <> 1").select("year", "table_id", "record_id")
    stray = m.where("sell % 75 = 2").select("year", "table_id", F.concat(F.lit("stray-"), "record_id").alias("record_id"))
    return there.unionByName(stray)


def jobs(spark: SparkSession) -> DataFrame:
    """A queue of 60 jobs of all kinds and states."""
    i = F.col("id")
    pick = lambda n, *v: F.element_at(F.array(*[F.lit(x) for x in v]), (i % n + 1).cast("int"))
    return spark.range(1, 61).select(
        i.alias("id"),
        pick(3, "full_sync", "hard_full_sync", "clear_partitions").alias("type"),
        (F.lit(1995) + i % 5).cast("int").alias("year"),
        pick(4, "ready", "claimed", "done", "dead").alias("status"),
        (i % 7).cast("long").alias("attempts"),
        F.timestamp_seconds(F.lit(1783684800) + (i - 30) * 60).cast("timestamp_ntz").alias("run_after"),
        F.concat(F.lit('{"appId":"a'), i.cast("string"), F.lit('","secret":"s"}')).alias("payload"),
    )
