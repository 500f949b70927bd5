"""Writes of records to a target behind a rate-limited interface: grouped by table, in batches, with another try.

A table holds at most a partition's capacity, so a task never holds more than one batch of one table.
Creating is idempotent by record id, so a task that is run again writes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import groupby
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from syncweave.sources import calls


class Gateway(Protocol):
    """What a target offers; it is sent to the executors.  Fields are JSON; a CallError with a retryable code is tried again."""

    def create(self, table_id: str, records: list[tuple[str, str]]) -> object: ...

    def update(self, table_id: str, records: list[tuple[str, str]]) -> object: ...

    def delete(self, table_id: str, record_ids: list[str]) -> object: ...


def _send(rows: DataFrame, call: Callable[[str, list], object], size: int, item: Callable[[Row], object]) -> None:
    def part(each: Iterable[Row]) -> None:
        for table_id, own in groupby(each, key=lambda r: r.table_id):
            for batch in calls.batches((item(r) for r in own), size):
                calls.retrying(lambda t=table_id, b=batch: call(t, b))

    rows.repartition("table_id").sortWithinPartitions("table_id", "record_id").foreachPartition(part)


def _fields(rows: DataFrame) -> DataFrame:
    return rows.select("table_id", "record_id", F.to_json("payload", {"ignoreNullFields": "false"}).alias("fields"))


def create(gateway: Gateway, rows: DataFrame) -> None:
    """rows(table_id, record_id, payload)."""
    _send(_fields(rows), gateway.create, calls.CREATE_BATCH, lambda r: (r.record_id, r.fields))


def update(gateway: Gateway, rows: DataFrame) -> None:
    _send(_fields(rows), gateway.update, calls.CREATE_BATCH, lambda r: (r.record_id, r.fields))


def delete(gateway: Gateway, rows: DataFrame) -> None:
    _send(rows.select("table_id", "record_id"), gateway.delete, calls.DELETE_BATCH, lambda r: r.record_id)
