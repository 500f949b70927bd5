"""The public entry points as methods over a store; arguments are checked, results are DataFrames or summaries."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncweave.functions.names import PER_YEAR, partition_name
from syncweave.operators import jobs, provision, reconcile, state
from syncweave.plans import incremental as inc
from syncweave.plans.commit import StateFolder, empty_states, with_state
from syncweave.schema import PAYLOAD, Field
from syncweave.sources import fact
from syncweave.storage import checkpointed


class NotFound(LookupError):
    """The year has no complete base."""


def check_year(year: object, bounded: bool = False) -> int:
    if isinstance(year, bool) or not isinstance(year, int):
        raise ValueError("year must be an integer")
    if bounded and not 2000 <= year <= 2100:
        raise ValueError("year must lie in 2000..2100")
    return year


def check_confirm(confirm: object) -> None:
    if confirm is not True:
        raise ValueError("confirm must be true")


class Service:
    """One driver owns the store; each call that changes it ends in a commit.

    With a folder a commit is a version on disk, and the store is read back from it; without one (tests) the tables are
    checkpointed.  Either way a plan starts at files, however many calls there were.
    """

    def __init__(
        self, store: inc.Store, history: DataFrame, today: DataFrame, capacity: int = 20_000, count: int = PER_YEAR, fields: tuple[Field, ...] = PAYLOAD, folder: StateFolder | None = None
    ) -> None:
        self.store, self.history, self.today = store, history, today
        self.capacity, self.count, self.fields, self.folder = capacity, count, fields, folder
        if store.states is None:
            self.store = replace(store, states=empty_states(history.sparkSession))

    def _commit(self, store: inc.Store) -> None:
        if self.folder is not None:
            self.store = self.folder.commit(store)
            return
        tables = {t: checkpointed(getattr(store, t)) for t in ("mapping", "partitions", "years", "target", "jobs", "states") if getattr(store, t) is not None}
        self.store = replace(store, **tables, touched=())

    @property
    def spark(self) -> SparkSession:
        return self.history.sparkSession

    def health(self) -> str:
        try:
            return "ok" if self.spark.sql("SELECT 1").count() == 1 else "degraded"
        except Exception:  # whatever keeps the session from answering
            return "degraded"

    # ---- bases

    def init_base(self, year: int, base_id: str, existing: DataFrame, budget: int | None = None) -> DataFrame:
        """Provisions a year: existing(name) are the target's tables; returns the status row."""
        check_year(year, bounded=True)
        if not isinstance(base_id, str) or not base_id.strip():
            raise ValueError("base must not be empty")
        got = provision.provision_status(existing, self.count, budget)
        made = provision.to_create(existing, self.count).orderBy("partition_no")
        made = made if budget is None else made.limit(budget)
        there = provision.in_range(existing, self.count).select("partition_no").union(made.select("partition_no")).distinct()
        rows = there.select(F.lit(year).alias("year"), "partition_no", F.concat(F.lit(f"{base_id}/"), partition_name(F.col("partition_no"))).alias("table_id"))
        known = self.store.partitions
        fresh = rows.join(known.select("year", "partition_no"), ["year", "partition_no"], "left_anti").withColumn("fill_count", F.lit(0).cast(known.schema["fill_count"].dataType))
        entry = got.select(F.lit(year).alias("year"), F.lit(base_id).alias("base_id"), "status")
        parts = known.unionByName(fresh, allowMissingColumns=True).select(*known.columns)
        self._commit(replace(self.store, partitions=parts, years=state.upsert(self.store.years, entry, ["year"]), touched=()))
        return got

    def remove_partitions(self, year: int, existing: DataFrame, dry_run: bool = False, budget: int | None = None) -> DataFrame:
        """The tables that go (or would), at most ``budget``; records, mappings and partition rows go with them.  A further call goes on."""
        self._base(check_year(year, bounded=True))
        gone = provision.removable(existing, self.count).withColumn("year", F.lit(year))
        if dry_run:
            return gone.select("name", "partition_no")
        gone = gone if budget is None else gone.orderBy("partition_no").limit(budget)
        gone = checkpointed(gone)
        s = self.store
        lost = s.partitions.join(F.broadcast(gone.select("year", "partition_no")), ["year", "partition_no"]).select("year", "table_id")
        left = s.target.join(F.broadcast(lost), ["year", "table_id"], "left_anti").select(*s.target.columns)
        self._commit(replace(s, mapping=state.delete_partitions(s.mapping, gone).select(*s.mapping.columns), partitions=state.delete_partitions(s.partitions, gone).select(*s.partitions.columns), target=left, touched=(year,)))
        return gone.select("name", "partition_no")

    def base_status(self, year: int) -> DataFrame:
        check_year(year, bounded=True)
        return provision.base_status(self._registered(year), self.store.partitions, self.count)

    # ---- synchronisation

    def incremental(self, **options) -> inc.Summary:
        done, got = inc.run_incremental(self.history, self.today, self.store, self.capacity, fields=self.fields, **options)
        if done is not self.store:
            self._commit(with_state(done, "incremental", last_utime=got.new_watermark))
        return got

    def enqueue(self, kind: str, year: int, confirm: object = None) -> DataFrame:
        """A full, hard-full or clear job for a complete year; the two that delete need a confirmation."""
        if kind not in jobs.BLOCKING:
            raise ValueError(f"no job type {kind}")
        check_year(year)
        if kind != "full_sync":
            check_confirm(confirm)
        self._base(year)
        wanted = self.spark.createDataFrame([(year,)], "year int")
        self._commit(replace(self.store, jobs=jobs.enqueue(self.store.jobs, self.store.years, kind, wanted), touched=()))
        return jobs.active(self.store.jobs, [kind]).where(F.col("year") == year).orderBy("id").limit(1)

    def full_status(self, year: int, kind: str = "full_sync") -> DataFrame:
        return jobs.latest(self.store.jobs, self.spark.createDataFrame([(check_year(year),)], "year int"), kind)

    def check(self, year: int, budget: int | None = None) -> DataFrame:
        """Counts of the year's next partitions, ``budget`` of them; a walk that has reached the end starts again."""
        self._base(check_year(year))
        s, (parts, scope, last) = self.store, self._walk(year, "full_sync_check", budget)
        here = F.col("year") == year
        found = checkpointed(reconcile.check_partitions(parts, s.mapping.where(here), s.target.where(here)))
        self._commit(with_state(replace(s, touched=()), scope, checkpoint=json.dumps({"lastPartitionNo": last})))
        return found

    def heal(self, year: int, budget: int | None = None) -> DataFrame:
        """What was done in the year's next partitions; records come back with their payload from the source's latest rows."""
        self._base(check_year(year))
        s, (parts, scope, last) = self.store, self._walk(year, "full_sync_heal", budget)
        rows = inc.prepared(fact.latest_per_key(fact.year_rows(self.history, year), fact.year_rows(self.today, year)), self.fields)
        mine = F.broadcast(parts.select("year", "table_id"))
        part = lambda df, how: df.join(mine, ["year", "table_id"], how).select(*df.columns)
        healed, done = inc.heal(replace(s, mapping=part(s.mapping, "left_semi"), partitions=parts, target=part(s.target, "left_semi")), rows)
        rest = s.partitions.join(mine, ["year", "table_id"], "left_anti").select(*s.partitions.columns)
        joined = replace(
            healed,
            mapping=part(s.mapping, "left_anti").unionByName(healed.mapping),
            partitions=rest.unionByName(healed.partitions),
            target=part(s.target, "left_anti").unionByName(healed.target, allowMissingColumns=True),
            touched=(year,),
        )
        self._commit(with_state(joined, scope, checkpoint=json.dumps({"lastPartitionNo": last})))
        return done

    def _walk(self, year: int, kind: str, budget: int | None) -> tuple[DataFrame, str, int]:
        """(the partitions of this call, the scope, the last one's number)."""
        scope, here = f"{kind}:{year}", self.store.partitions.where(F.col("year") == year)
        at = state.last_partition(self.store.states, scope).first()
        end = here.agg(F.coalesce(F.max("partition_no"), F.lit(0)).alias("m")).first().m
        after = 0 if at is None or at.after >= end else at.after
        parts = checkpointed(state.walk(here, after, budget))
        return parts, scope, parts.agg(F.coalesce(F.max("partition_no"), F.lit(after)).alias("m")).first().m

    def state(self, scope: str) -> DataFrame:
        return state.get_state(self.store.states, scope)

    # ---- the worker

    def handlers(self) -> dict[str, Callable[[int], object]]:
        def backfill(year: int) -> inc.Summary:
            done, got = inc.run_backfill(self.history, self.today, year, self.store, self.capacity, self.fields)
            self._commit(with_state(done, f"full_sync:{year}", status="done"))
            return got

        def clear(year: int) -> None:
            self._commit(inc.clear_year(self.store, year))

        def hard(year: int) -> None:
            cleared = inc.clear_year(self.store, year)
            self._commit(replace(cleared, jobs=jobs.enqueue(cleared.jobs, cleared.years, "full_sync", self.spark.createDataFrame([(year,)], "year int"))))

        return {"full_sync": backfill, "clear_partitions": clear, "hard_full_sync": hard}

    def work(self, now: datetime) -> tuple[int | None, str]:
        """Claims and runs one due job: (its id, done, ready for another try, dead, or idle)."""
        mine, queue = jobs.claim(self.store.jobs, now)
        job = mine.first()
        if job is None:
            return None, "idle"
        self._queue(queue)
        handler = self.handlers().get(job.type)
        one = F.col("id") == job.id
        if handler is None:
            self._queue(jobs.scrub(self.store.jobs.withColumn("status", F.when(one, "dead").otherwise(F.col("status")))))
            return job.id, "dead"
        try:
            handler(job.year)
        except Exception:  # whatever went wrong, the queue's rule decides on another try
            rest = self.store.jobs.where(~one)
            self._queue(jobs.scrub(rest.unionByName(jobs.after_failure(self.store.jobs.where(one), now))))
            return job.id, self.store.jobs.where(one).first().status
        self._queue(jobs.scrub(jobs.complete(self.store.jobs, job.id)))
        return job.id, "done"

    def _queue(self, queue: DataFrame) -> None:
        self._commit(replace(self.store, jobs=queue, touched=()))

    # ---- shared

    def _registered(self, year: int) -> DataFrame:
        rows = self.store.years.where(F.col("year") == year)
        if not rows.limit(1).count():
            raise NotFound(f"year {year} has no base")
        return rows

    def _base(self, year: int) -> None:
        if not self._registered(year).where("status = 'complete'").limit(1).count():
            raise NotFound(f"the base of year {year} is not complete")
