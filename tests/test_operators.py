import random

import pytest
from pyspark.sql import functions as F

from syncweave.operators import changes, jobs, packing, provision, quality, reconcile, state
from syncweave.plans.frames import NOW
from syncweave.sources import fact

ROW = "SellBranch long, SellID long, RowNo long, CrTime string, UTime string"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_takes_the_newest_and_history_on_ties(spark):
    old = spark.createDataFrame([(1, 1, 1, "h", "2569-01-01 08:00:00"), (1, 2, 1, "h", "2569-01-01 07:00:00")], ROW)
    new = spark.createDataFrame([(1, 1, 1, "t", "2569-01-01 09:30:00"), (1, 2, 1, "t", "2569-01-01 07:00:00")], ROW)
    assert rows(fact.latest_per_key(old, new), "SellID", "CrTime") == [(1, "t"), (2, "h")]


def test_changed_since_is_inclusive_and_looks_back(spark):
    old = spark.createDataFrame([(1, i, 1, "c", f"2569-07-08 20:58:0{i}") for i in range(5)], ROW)
    none = old.limit(0)
    assert rows(fact.changed_since(old, none, "2026-07-08 20:58:03"), "SellID") == [(3,), (4,)]
    assert rows(fact.changed_since(old, none, "2026-07-08 20:58:03", lookback_seconds=2), "SellID") == [(1,), (2,), (3,), (4,)]


def test_fetch_by_full_key(spark):
    df = spark.createDataFrame([(114, 10, 1, "", ""), (999, 10, 1, "", "")], ROW)
    keys = spark.createDataFrame([("114|10|1",)], "source_key string")
    assert rows(fact.by_keys(df, keys), "SellBranch") == [(114,)]


def test_pages_cover_every_row_once(spark):
    df = spark.createDataFrame([(b, s, r, "2567-05-01 00:00:00", "") for b in (1, 2) for s in range(5) for r in (1, 2)], ROW)
    seen, after = [], None
    while page := fact.chunk(df, 2024, 3, after).collect():
        seen += [(p.SellID, p.RowNo, p.SellBranch) for p in page]
        after = seen[-1]
    assert len(seen) == 20 == len(set(seen)) and seen == sorted(seen)


def test_routing_and_counters(spark):
    src = spark.createDataFrame([(2026, "a", "1"), (2026, "b", "2"), (2026, "c", "3"), (2015, "d", "4"), (2027, "e", "5")], "year int, source_key string, checksum string")
    known = spark.createDataFrame([(2026, "b", "2", 1, "t", "r"), (2026, "c", "x", 1, "t", "r")], "year int, source_key string, checksum string, partition_no int, table_id string, record_id string")
    years = spark.createDataFrame([(2026, "B", "complete"), (2027, "C", "partial")], "year int, base_id string, status string")
    got = changes.classify(src, known, years)
    assert rows(got, "source_key", "action") == [("a", "insert"), ("b", "skip"), ("c", "update"), ("d", "ignore"), ("e", "ignore")]
    c = changes.counters(got).first()
    assert (c.scanned, c.inserted, c.updated, c.skipped, c.ignored_rows, list(c.ignored_years)) == (5, 1, 1, 1, 2, [2015, 2027])


def parts(spark, fills):
    return spark.createDataFrame([(2024, n, f"tbl{n}", f) for n, f in fills.items()], "year int, partition_no int, table_id string, fill_count long")


def need(spark, n):
    return spark.createDataFrame([(2024, n)], "year int, need long")


def test_reserve_vector(spark):
    got = packing.segments(parts(spark, {3: 19980, 4: 0}), need(spark, 50), 20_000)
    assert rows(got, "partition_no", "start_index", "count") == [(3, 19980, 20), (4, 0, 30)]


def test_capacity_shortfall(spark):
    assert rows(packing.shortfalls(parts(spark, {1: 20_000}), need(spark, 5), 20_000), "year", "missing") == [(2024, 5)]
    assert packing.shortfalls(parts(spark, {1: 19_000}), need(spark, 1000), 20_000).count() == 0


def test_segments_like_step_by_step_reservation(spark):
    rnd = random.Random(5)
    for _ in range(6):
        cap = rnd.randint(1, 9)
        fills = {n: rnd.randint(0, cap) for n in range(1, 8)}
        room = sum(cap - f for f in fills.values())
        n = rnd.randint(0, room)
        want, left, now = [], n, dict(fills)
        for p in sorted(now):
            take = min(cap - now[p], left)
            if take:
                want.append((p, now[p], take))
                left -= take
        assert rows(packing.segments(parts(spark, fills), need(spark, n), cap), "partition_no", "start_index", "count") == want


def test_boundaries_need_slot_zero_for_first(spark):
    got = spark.createDataFrame([(2024, 1, 49998, "a"), (2024, 1, 49999, "b"), (2024, 2, 0, "c")], "year int, partition_no int, slot long, source_key string")
    assert {(r.partition_no, r.first_source_key, r.last_source_key) for r in packing.boundaries(got).collect()} == {(1, None, "b"), (2, "c", "c")}


def test_numbering_by_ranges_equals_one_window(spark):
    df = spark.range(2000).select((F.col("id") % 2 + 2024).cast("int").alias("year"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 97).alias("a"), "id")
    assert rows(packing.number_rows(df, ["a", "id"]), "year", "id", "rn") == rows(packing.number_rows(df, ["a", "id"], wide=True), "year", "id", "rn")


@pytest.mark.parametrize(("real", "want"), [(480, 480), (500, 500), (600, 500)])
def test_fill_moves_down_only(spark, real, want):
    counted = spark.createDataFrame([("tbl1", real)], "table_id string, n_target long")
    assert packing.correct_fill(parts(spark, {1: 500}), counted, 20_000).first().fill_count == want


def store(spark, mapped, there, fill):
    p = parts(spark, {1: fill})
    m = spark.createDataFrame([(2024, 1, "tbl1", f"r{i}", f"k{i}") for i in mapped], "year int, partition_no int, table_id string, record_id string, source_key string")
    t = spark.createDataFrame([(2024, "tbl1", f"r{i}") for i in there], "year int, table_id string, record_id string")
    return p, m, t


def test_drift_status(spark):
    assert reconcile.check_partitions(*store(spark, range(8), range(8), 9)).first().status == "fill_count_drift"
    assert reconcile.check_partitions(*store(spark, range(8), range(9), 9)).first().status == "target_drift"
    assert reconcile.check_partitions(*store(spark, range(8), range(8), 8)).first().status == "ok"


def test_heal_sees_drift_that_cancels(spark):
    p, m, t = store(spark, range(3), [0, 1, "x"], 3)
    assert reconcile.check_partitions(p, m, t).first().status == "ok"
    src = spark.createDataFrame([("k0",), ("k1",), ("k2",)], "source_key string")
    assert rows(reconcile.heal_actions(p, m, t, src), "orphans_deleted", "recreated") == [(1, 1)]
    assert rows(reconcile.heal_actions(p, m, t, src.where("source_key <> 'k2'")), "orphans_deleted", "recreated") == [(1, 0)]
    assert rows(reconcile.unrecoverable(reconcile.missing(m, t), src.where("source_key <> 'k2'")), "source_key") == [("k2",)]


def test_backfill_incomplete(spark):
    checked = reconcile.check_partitions(*store(spark, range(4), range(4), 4))
    assert reconcile.check_summary(checked, spark.createDataFrame([(2024, 5)], "year int, n_source long")).first().backfill_incomplete


def test_upsert_is_idempotent_and_keeps_immutable_columns(spark):
    kind = "year int, source_key string, base_id string, partition_no int, table_id string, record_id string, checksum string, cr_time string, u_time string"
    old = spark.createDataFrame([(1, "a", "B", 1, "t", "r", "1", "c", "u"), (1, "b", "B", 1, "t", "r", "1", "c", "u")], kind)
    new = spark.createDataFrame([(1, "a", "X", 2, "t2", "r2", "2", "X", "u2"), (1, "n", "N", 3, "t", "r", "1", "c", "u")], kind)
    once = state.upsert_mapping(old, new)
    assert rows(once, "source_key", "base_id", "partition_no", "cr_time", "checksum") == [("a", "B", 2, "c", "2"), ("b", "B", 1, "c", "1"), ("n", "N", 3, "c", "1")]
    assert rows(state.upsert_mapping(once, new), *old.columns) == rows(once, *old.columns)


def test_patch_never_nulls(spark):
    old = spark.createDataFrame([("s", "w", "idle")], "scope string, last_utime string, status string")
    new = spark.createDataFrame([("s", None, "busy"), ("n", "z", None)], "scope string, last_utime string, status string")
    got = {(r.scope, r.last_utime, r.status) for r in state.patch(old, new, ["scope"]).collect()}
    assert got == {("s", "w", "busy"), ("n", "z", None)}


def test_deletes_of_nothing(spark):
    _, m, _ = store(spark, range(3), [], 0)
    assert state.delete_years(m).count() == 3 and state.delete_years(m, 2024).count() == 0
    assert state.delete_partitions(m, m.limit(0)).count() == 3


def test_provisioning(spark):
    have = spark.createDataFrame([("itec_001",), ("Table",), ("daily_01",), ("itec_099",)], "name string")
    assert rows(provision.to_create(have, 3), "name") == [("itec_002",), ("itec_003",)]
    assert provision.in_range(have, 3).count() == 1
    s = provision.provision_status(have, 3).first()
    assert (s.existing, s.created, s.remaining, s.status) == (1, 2, 0, "complete")
    years = spark.createDataFrame([(2024, "B", "partial")], "year int, base_id string, status string")
    b = provision.base_status(years, parts(spark, {1: 0}), 3).first()
    assert (b.existing, b.missing, b.complete) == (1, 2, False)


def queue(spark, *js):
    return spark.createDataFrame([(*j, NOW, '{"appId":"a","secret":"s"}') for j in js], "id long, type string, year int, status string, attempts long, run_after timestamp_ntz, payload string")


def test_queue_rules(spark):
    q = queue(spark, (1, "full_sync", 2024, "claimed", 1), (2, "full_sync", 2025, "claimed", 5), (3, "full_sync", 2026, "ready", 0), (4, "full_sync", 2026, "ready", 0))
    assert rows(jobs.after_failure(q, NOW), "id", "status", "attempts") == [(1, "ready", 2), (2, "dead", 5), (3, "ready", 0), (4, "ready", 0)]
    mine, after = jobs.claim(q, NOW)
    assert rows(mine, "id", "status") == [(3, "ready")] and rows(after.where("id >= 3"), "id", "status") == [(3, "claimed"), (4, "ready")]
    assert jobs.active(q, ()).count() == 0
    assert jobs.scrub(jobs.after_failure(q, NOW)).where("id = 2").first().payload == '{"appId":"a"}'
    years = spark.createDataFrame([(2026, "B", "complete"), (2027, "C", "complete"), (2028, "D", "partial")], "year int, base_id string, status string")
    grown = jobs.enqueue(q, years, "full_sync", years.select("year"))
    assert rows(grown.where("id > 4"), "id", "year", "status") == [(5, 2027, "ready")]
    assert jobs.latest(q, years.where("year = 2027"), "full_sync").first().status == "not_started"


def test_preflight(spark):
    df = spark.createDataFrame([(1, 1, 1, "2569-01-01 00:00:00", "")] * 2, ROW)
    got = {r.name: r.status for r in quality.preflight(df, None).collect()}
    assert got["identity_unique"] == "FAIL" and got["era"] == "PASS" and got["today_columns"] == "FAIL" and got["identity_not_null"] == "PASS"
    assert quality.exit_code(quality.preflight(df, df)) == 1


def test_batches(spark):
    df = spark.createDataFrame([(2024, i) for i in range(5)], "year int, a int")
    assert [r.batch for r in changes.batch_ordinals(df, ["a"], 2).orderBy("a").collect()] == [0, 0, 1, 1, 2]
