"""Reads of the fact table and its delta of the current day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncweave.functions import eras
from syncweave.functions.identity import derive_key
from syncweave.schema import KEY


def keyset_after(cols: Sequence[str], cursor: Sequence[int]) -> Column:
    """Rows after a cursor in the order of ``cols``, in the form that scans can push down."""
    found = F.lit(False)
    for i in reversed(range(len(cols))):
        found = (F.col(cols[i]) > cursor[i]) | ((F.col(cols[i]) == cursor[i]) & found)
    return found


def chunk(fact: DataFrame, year: int, limit: int, after: Sequence[int] | None = None, order: Sequence[str] = ("SellID", "RowNo", "SellBranch")) -> DataFrame:
    """One page of a year by the full key; a missing cursor starts before the first row."""
    rows = fact.where(eras.in_year(F.col("CrTime"), year))
    if after is not None:
        rows = rows.where(keyset_after(order, after))
    return rows.orderBy(*order).limit(limit)


def year_rows(fact: DataFrame, year: int) -> DataFrame:
    """A whole year as one partitioned scan; a backfill needs no cursor."""
    return fact.where(eras.in_year(F.col("CrTime"), year))


def count_year(fact: DataFrame, year: int) -> DataFrame:
    return year_rows(fact, year).agg(F.count("*").alias("n_rows"))


def latest_per_key(history: DataFrame, today: DataFrame | None = None, key: Sequence[str] = KEY, tie: Sequence[str] = ()) -> DataFrame:
    """The row with the largest update time of each key; at equal times history wins, then the tie columns.

    One aggregate with a map-side combine: a key's rows are never gathered or sorted together.
    """
    rows = history.withColumn("_src", F.lit(0))
    if today is not None:
        rows = rows.unionByName(today.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in rows.columns if c != "_src"]
    order = F.struct(F.col("UTime"), (-F.col("_src")).alias("_r"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie)])
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), order).alias("_row"))
    return best.select("_row.*")


def changed_since(history: DataFrame, today: DataFrame, since_ce: str, lookback_seconds: int = 0, key: Sequence[str] = KEY, tie: Sequence[str] = ()) -> DataFrame:
    """Latest versions of rows whose update time is at or after a Common-Era watermark.

    The bound is a literal on the raw string, so it is pushed to both scans.  ``lookback_seconds`` reaches
    back for late rows.
    """
    bound = _be_bound(since_ce, lookback_seconds)
    late = F.col("UTime") >= bound
    return latest_per_key(history.where(late), today.where(late), key, tie)


def _be_bound(since_ce: str, lookback_seconds: int) -> str:
    from datetime import datetime, timedelta

    at = datetime.strptime(since_ce[:19], "%Y-%m-%d %H:%M:%S") - timedelta(seconds=lookback_seconds)
    return f"{at.year + eras.OFFSET_YEARS:04d}{at:-%m-%d %H:%M:%S}" + (since_ce[19:] if not lookback_seconds else "")


def by_keys(fact: DataFrame, keys: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows whose full key is in keys(source_key); nothing is assumed of the number of keys."""
    return fact.withColumn("source_key", derive_key(*key)).join(keys.select("source_key").distinct(), "source_key", "left_semi")


def sample_row(fact: DataFrame) -> DataFrame:
    """One row that has a creation time."""
    return fact.where(F.col("CrTime").isNotNull()).limit(1)
