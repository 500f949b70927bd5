"""The job queue's rules as transforms of a table jobs(id, type, year, status, attempts, run_after, payload)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKING = ("full_sync", "hard_full_sync", "clear_partitions")
MAX_ATTEMPTS = 5
RETRY_SECONDS = 60


def active(jobs: DataFrame, types: Sequence[str] = BLOCKING) -> DataFrame:
    """Jobs of these types that wait or run; no types, no jobs."""
    return jobs.where(F.col("status").isin("ready", "claimed") & (F.col("type").isin(*types) if types else F.lit(False)))


def oldest_active(jobs: DataFrame, types: Sequence[str] = BLOCKING) -> DataFrame:
    return active(jobs, types).groupBy("type", "year").agg(F.min("id").alias("id"))


def latest(jobs: DataFrame, years: DataFrame, kind: str) -> DataFrame:
    """Each year's newest job of a type in any status; ``not_started`` where there is none."""
    last = jobs.where(F.col("type") == kind).groupBy("year").agg(F.max_by(F.struct("id", "status", "attempts"), "id").alias("j")).select("year", "j.*")
    return years.select("year").join(last, "year", "left").withColumns({"status": F.coalesce("status", F.lit("not_started")), "attempts": F.coalesce("attempts", F.lit(0)).cast("long")})


def claimable(jobs: DataFrame, now: datetime, limit: int = 1) -> DataFrame:
    """Due jobs in order of arrival."""
    due = (F.col("status") == "ready") & (F.col("run_after").isNull() | (F.col("run_after") <= F.lit(now).cast("timestamp_ntz")))
    return jobs.where(due).orderBy("id").limit(limit)


def claim(jobs: DataFrame, now: datetime, limit: int = 1) -> tuple[DataFrame, DataFrame]:
    """(the claimed jobs as they were, the queue after the claim); one driver owns the queue."""
    mine = claimable(jobs, now, limit)
    hit = F.broadcast(mine.select(F.col("id").alias("_id")))
    after = jobs.join(hit, F.col("id") == F.col("_id"), "left").withColumn("status", F.when(F.col("_id").isNotNull(), "claimed").otherwise(F.col("status"))).drop("_id")
    return mine, after


def after_failure(jobs: DataFrame, failed_at: datetime, max_attempts: int = MAX_ATTEMPTS, delay: int = RETRY_SECONDS) -> DataFrame:
    """Claimed jobs become ready again later, or dead once their attempts are used up."""
    failed, dead = F.col("status") == "claimed", F.col("attempts") >= max_attempts
    later = (F.lit(failed_at).cast("timestamp_ntz") + F.expr(f"interval {delay} seconds")).cast("timestamp_ntz")
    return jobs.withColumns(
        {
            "status": F.when(failed & dead, "dead").when(failed, "ready").otherwise(F.col("status")),
            "attempts": F.when(failed & ~dead, F.col("attempts") + 1).otherwise(F.col("attempts")).cast("long"),
            "run_after": F.when(failed & ~dead, later).otherwise(F.col("run_after")),
        }
    )


def complete(jobs: DataFrame, *ids: int) -> DataFrame:
    return jobs.withColumn("status", F.when(F.col("id").isin(*ids), "done").otherwise(F.col("status"))) if ids else jobs


def scrub(jobs: DataFrame) -> DataFrame:
    """The payload of finished jobs keeps its application id only."""
    over = F.col("status").isin("done", "dead")
    return jobs.withColumn("payload", F.when(over, F.to_json(F.struct(F.get_json_object("payload", "$.appId").alias("appId")))).otherwise(F.col("payload")))


def enqueue(jobs: DataFrame, years: DataFrame, kind: str, wanted: DataFrame) -> DataFrame:
    """New ready jobs for wanted(year): the year must be complete, and no active job of the kind may exist."""
    ok = wanted.join(F.broadcast(years.where(F.col("status") == "complete").select("year")), "year", "left_semi")
    fresh = ok.join(active(jobs, [kind]).select("year"), "year", "left_anti").distinct()
    top = jobs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    from pyspark.sql import Window

    rows = fresh.crossJoin(F.broadcast(top)).select((F.col("_top") + F.row_number().over(Window.orderBy("year"))).cast("long").alias("id"), F.lit(kind).alias("type"), "year", F.lit("ready").alias("status"), F.lit(0).cast("long").alias("attempts"))
    return jobs.unionByName(rows, allowMissingColumns=True)
