"""The flagship dataflow and the other runs.

A run computes what is to be written once, writes records to the target (through a gateway, where there is one) and
returns the new store.  Whoever owns the store commits it (plans.commit): tables first, the watermark last.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncweave.functions import eras
from syncweave.functions.identity import derive_key, fingerprint, record_id
from syncweave.operators import changes, packing, reconcile, state
from syncweave.schema import KEY, PAYLOAD, Field, transform
from syncweave.sources import fact, target, writer
from syncweave.storage import checkpointed

SEED = "2026-07-03 00:00:00"


class CapacityError(RuntimeError):
    """Open partitions can't take a year's rows; nothing has been written."""


class Blocked(RuntimeError):
    """A background job that rewrites the target waits or runs."""


@dataclass
class Store:
    """The ops tables and the target, replaced as a whole by each commit."""

    mapping: DataFrame
    partitions: DataFrame
    years: DataFrame
    target: DataFrame
    watermark: str | None = None
    jobs: DataFrame | None = None
    states: DataFrame | None = None
    gateway: writer.Gateway | None = None
    #: years whose rows differ from the last commit; None: any
    touched: tuple[int, ...] | None = ()


@dataclass(frozen=True)
class Summary:
    since: str
    new_watermark: str
    scanned: int = 0
    inserted: int = 0
    updated: int = 0
    skipped: int = 0
    ignored_rows: int = 0
    ignored_years: tuple[int, ...] = ()


def prepared(rows: DataFrame, fields: tuple[Field, ...] = PAYLOAD, key: Sequence[str] = KEY) -> DataFrame:
    """year, source_key, payload, checksum, and the raw times of conformed rows."""
    named = rows.withColumns({"year": eras.cr_year(F.col("CrTime")), "source_key": derive_key(*key), "_cr": F.col("CrTime"), "_u": F.col("UTime")})
    conformed = transform(named, "year", "source_key", "_cr", "_u", *key, fields=fields)
    return conformed.withColumn("checksum", fingerprint(*[F.col(f"payload.`{f.name}`").alias(f.name) for f in fields]))


def plan(rows: DataFrame, store: Store, capacity: int, fields: tuple[Field, ...] = PAYLOAD, wide: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classified rows, inserts with their slots, segments); lazy but for a wide numbering."""
    ready = prepared(rows, fields)
    classified = changes.classify(ready, store.mapping, store.years)
    new = classified.where("action = 'insert'").drop("partition_no", "table_id", "record_id")
    numbered = packing.number_rows(new, ["_u", "SellID", "RowNo", "SellBranch"], wide=wide)
    need = new.groupBy("year").agg(F.count("*").alias("need"))
    taken = packing.segments(store.partitions, need, capacity)
    return classified, packing.assign_slots(numbered, taken), taken


def run_incremental(history: DataFrame, today: DataFrame, store: Store, capacity: int = 20_000, seed: str = SEED, lookback_seconds: int = 0, fields: tuple[Field, ...] = PAYLOAD) -> tuple[Store, Summary]:
    """One sweep.  The watermark is stamped last, so a run that breaks off is repeated, and a repeat skips."""
    if store.jobs is not None and changes_blocked(store.jobs):
        raise Blocked("a full, hard-full or clear job is active")
    since = store.watermark or seed
    rows = fact.changed_since(history, today, since, lookback_seconds)
    return _apply(rows, store, capacity, since, fields)


def changes_blocked(jobs: DataFrame) -> bool:
    from syncweave.operators.jobs import active

    return bool(active(jobs).limit(1).count())


def run_backfill(history: DataFrame, today: DataFrame | None, year: int, store: Store, capacity: int = 20_000, fields: tuple[Field, ...] = PAYLOAD) -> tuple[Store, Summary]:
    """All rows of a year by the same plan: rows that are mapped already are skipped or updated, not added again."""
    keep = store.watermark
    here = store.target.where(F.col("year") == year)
    fixed = packing.correct_fill(store.partitions.where(F.col("year") == year), target.count_records(here), capacity)
    store = replace(store, partitions=store.partitions.where(F.col("year") != year).unionByName(fixed))
    rows = fact.latest_per_key(fact.year_rows(history, year), None if today is None else fact.year_rows(today, year))
    done, summary = _apply(rows, store, capacity, keep or "", fields, wide=True)
    done.watermark = keep
    return done, summary


def _apply(rows: DataFrame, store: Store, capacity: int, since: str, fields: tuple[Field, ...], wide: bool = False) -> tuple[Store, Summary]:
    # the rows are written once: counters, segments and slots all read the same version of them
    rows = checkpointed(rows.withColumn("_year", eras.cr_year(F.col("CrTime"))))
    seen = tuple(sorted(r._year for r in rows.select("_year").distinct().collect() if r._year is not None))  # a row a year
    rows = rows.drop("_year")
    part = replace(store, mapping=store.mapping.where(F.col("year").isin(*seen)) if seen else store.mapping.limit(0))
    classified, placed, taken = plan(rows, part, capacity, fields, wide)
    classified = checkpointed(classified)
    counts = changes.counters(classified).first()
    if not counts.scanned:
        return store, Summary(since, since)
    mark = classified.agg(eras.watermark(F.max("_u")).alias("w")).first().w
    need = classified.where("action = 'insert'").groupBy("year").agg(F.count("*").alias("need"))
    short = packing.shortfalls(store.partitions, need, capacity).collect()  # one row a year
    if short:
        raise CapacityError("; ".join(f"no partition capacity left for year {r.year}: {r.missing} of {r.need} rows too many" for r in short))
    placed = checkpointed(placed.withColumn("record_id", record_id(F.col("year"), F.col("source_key"))))
    moved = classified.where("action = 'update'")
    ce = lambda c: F.expr(f"concat(cast(try_cast(substring({c}, 1, 4) as int) - {eras.OFFSET_YEARS} as string), substring({c}, 5))")
    cols = ["year", "base_id", "source_key", "partition_no", "table_id", "record_id", "checksum", ce("_cr").alias("cr_time"), ce("_u").alias("u_time")]
    touched = placed.select(*cols).unionByName(moved.select(*cols))
    years = tuple(r.year for r in touched.select("year").distinct().orderBy("year").collect())
    record = ["year", "table_id", "record_id", "payload"]
    if store.gateway is not None:
        writer.create(store.gateway, placed.select(*record))
        writer.update(store.gateway, moved.select(*record))
    new_target = target.update_records(target.create_records(store.target, placed.select(*record)), moved.select(*record))
    fills = state.patch(store.partitions, _grown(store.partitions, taken), ("year", "partition_no"))
    parts = state.update_boundaries(fills, packing.boundaries(placed))
    mapping = state.upsert_mapping(store.mapping, touched)
    done = replace(store, mapping=mapping, partitions=parts, target=new_target, watermark=mark, touched=years)
    return done, Summary(since, mark, counts.scanned, counts.inserted, counts.updated, counts.skipped, counts.ignored_rows, tuple(counts.ignored_years))


def _grown(partitions: DataFrame, taken: DataFrame) -> DataFrame:
    return taken.select("year", "partition_no", (F.col("start_index") + F.col("count")).cast(partitions.schema["fill_count"].dataType).alias("fill_count"))


def clear_year(store: Store, year: int) -> Store:
    """A year's records, mappings, fill pointers and backfill checkpoint gone; its tables stay."""
    here = F.col("year") == year
    if store.gateway is not None:
        writer.delete(store.gateway, store.target.where(here))
    left = None if store.states is None else state.clear_state(store.states, f"full_sync:{year}")
    return replace(store, mapping=state.delete_years(store.mapping, year), partitions=state.reset_partitions(store.partitions, year), target=store.target.where(~here), states=left, touched=(year,))


def heal(store: Store, source_rows: DataFrame) -> tuple[Store, DataFrame]:
    """(the healed store, what was done by partition): orphans go, missing records come back whole, fills are recounted.

    source_rows(source_key, payload, checksum) of the years of the store; the mapping takes the fingerprint of what is written.
    """
    lost = checkpointed(reconcile.missing(store.mapping, store.target).join(source_rows.select("source_key", "payload", F.col("checksum").alias("_c")), "source_key"))
    gone = checkpointed(reconcile.orphans(store.target, store.mapping))
    n = lambda rows, name: rows.groupBy("table_id").agg(F.count("*").cast("long").alias(name))
    found = store.partitions.select("year", "partition_no", "table_id").join(n(gone, "orphans_deleted"), "table_id", "left").join(n(lost, "recreated"), "table_id", "left")
    done = checkpointed(found.na.fill(0, ["orphans_deleted", "recreated"]).where("orphans_deleted > 0 or recreated > 0"))
    record = lost.select("year", "table_id", "record_id", "payload")
    if store.gateway is not None:
        writer.delete(store.gateway, gone)
        writer.create(store.gateway, record)
    healed = target.create_records(target.delete_records(store.target, gone), record)
    mapping = state.upsert_mapping(store.mapping, lost.drop("payload", "checksum").withColumnRenamed("_c", "checksum").select(*store.mapping.columns))
    touched = tuple(r.year for r in done.select("year").distinct().collect())
    return replace(store, mapping=mapping, partitions=state.set_fill(store.partitions, store.mapping), target=healed, touched=touched), done
