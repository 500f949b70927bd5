"""Business keys and content fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def derive_key(*parts: str | Column) -> Column:
    """``branch|sell|row``; a missing part is written as ``null``."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])


def parse_key(key: Column) -> tuple[Column, Column, Column]:
    """Branch, sell id and row number of a key, null where they are no numbers."""
    parts = F.split(key, r"\|")
    return tuple(F.try_element_at(parts, F.lit(i)).try_cast("long") for i in (1, 2, 3))


def crc32(text: Column) -> Column:
    """Unsigned IEEE CRC-32 of the UTF-8 bytes."""
    return F.crc32(text.cast("binary"))


def canonical_json(*fields: str | Column) -> Column:
    """Fields in order, nulls written."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def canonical_text(fields: Sequence[Column]) -> Column:
    """Fields in order as text, for fingerprints that other engines have to reproduce."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("null")) for c in fields])


def fingerprint(*fields: str | Column) -> Column:
    return crc32(canonical_json(*fields))


def record_id(year: Column, key: Column) -> Column:
    """The target id of a record: a function of its identity, so a repeated write makes no second record."""
    return F.concat(F.lit("rec"), F.substring(F.md5(F.concat_ws("|", year.cast("string"), key)), 1, 20))
