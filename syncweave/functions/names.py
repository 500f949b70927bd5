"""Names of partitions of the target."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How the target's tables are named, how many a year has, how many rows one takes.
PREFIX = "itec_"
PER_YEAR = 250
ROWS = 20_000


def partition_name(no: Column, prefix: str = PREFIX) -> Column:
    """The prefix and the number with at least three digits."""
    text = no.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text))


def parse_partition_no(name: Column, prefix: str = PREFIX) -> Column:
    """The number of a name with exactly three digits, else null."""
    return F.regexp_extract(name, rf"^{prefix}(\d{{3}})$", 1).try_cast("int")


def remaining(capacity: Column, fill: Column) -> Column:
    return capacity - fill


def is_full(capacity: Column, fill: Column) -> Column:
    return fill >= capacity
