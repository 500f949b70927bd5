"""Buddhist-Era calendar strings, Common-Era strings and instants.

The era year is shifted before a date is built, as the two eras do not share leap years.  A value
that is no date of the Common Era becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET_YEARS = 543
ZONE_HOURS = 7
_STRICT = r"^\d{4}-\d{2}-\d{2} ([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?$"


def be_to_epoch_ms(be: Column, offset: int = OFFSET_YEARS, zone_hours: int = ZONE_HOURS) -> Column:
    """Milliseconds since the epoch of a wall clock ``yyyy-MM-dd HH:mm:ss[.f+]``; the fraction is cut to three digits.

    Days and seconds are counted as integers, so the session's zone has no part in it.
    """
    number = lambda at, n: F.substring(be, at, n).try_cast("int")
    ce = F.concat(F.lpad((number(1, 4) - offset).cast("string"), 4, "0"), F.substring(be, 5, 6))
    seconds = F.unix_date(ce.try_cast("date")).cast("long") * 86_400 + number(12, 2) * 3600 + number(15, 2) * 60 + number(18, 2) - zone_hours * 3600
    millis = F.coalesce(F.rpad(F.substring(be, 21, 3), 3, "0").try_cast("int"), F.lit(0))
    return F.when(be.rlike(_STRICT), seconds * 1000 + millis)


def epoch_ms_to_utc(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC, whole seconds, whatever the session's zone."""
    days = F.floor(ms / 86_400_000)
    rest = F.floor((ms - days * 86_400_000) / 1000)
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    clock = F.concat_ws(":", two(F.floor(rest / 3600)), two(F.floor(rest % 3600 / 60)), two(rest % 60))
    return F.when(ms.isNotNull(), F.concat_ws(" ", F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")).cast("string"), clock))


def _shift(text: Column, years: int) -> Column:
    return F.concat((F.substring(text, 1, 4).try_cast("int") + years).cast("string"), F.substring(text, 5, 1_000_000))


def be_to_ce(be: Column) -> Column:
    """The same string with its year in the Common Era."""
    return _shift(be, -OFFSET_YEARS)


def ce_to_be(ce: Column) -> Column:
    return _shift(ce, OFFSET_YEARS)


def be_year_bounds(year: int) -> tuple[str, str]:
    """Half-open bounds of a Common-Era year on raw strings, so that the filter reaches the scan."""
    be = year + OFFSET_YEARS
    return f"{be:04d}-01-01 00:00:00", f"{be + 1:04d}-01-01 00:00:00"


def in_year(be: Column, year: int) -> Column:
    low, high = be_year_bounds(year)
    return (be >= low) & (be < high)


def cr_year(be: Column) -> Column:
    """The Common-Era year on the wall clock."""
    return F.substring(be, 1, 4).try_cast("int") - OFFSET_YEARS


def floor_second(text: Column) -> Column:
    return F.substring(text, 1, 19)


def watermark(be: Column) -> Column:
    """A watermark from a Buddhist-Era update time: Common Era, cut to the second."""
    return floor_second(be_to_ce(be))


def classify_era(text: Column) -> Column:
    """BE, CE or unknown by the year; no sample where there is none."""
    year = F.substring(text, 1, 4).try_cast("int")
    return F.when(year.isNull(), "no_sample").when(year.between(2400, 2700), "BE").when(year.between(1900, 2100), "CE").otherwise("unknown")
