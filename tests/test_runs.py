import pytest

from syncweave.plans import incremental as inc
from syncweave.plans.commit import StateFolder
from syncweave.sources.calls import CallError
from syncweave.streaming.sweep import start, sweep_batch

ROW = "SellBranch long, SellID long, RowNo long, CrTime string, UTime string, Product string, SRP double"
MAP = "year int, base_id string, source_key string, partition_no int, table_id string, record_id string, checksum long, cr_time string, u_time string"
PART = "year int, partition_no int, table_id string, fill_count long, first_source_key string, last_source_key string"


def lines(spark, n, srp=1.0, at="2569-07-04 10:00:00", year=2569, first=0):
    return spark.createDataFrame([(1, i, 1, f"{year}-02-01 00:00:00", at, "P", srp) for i in range(first, first + n)], ROW)


def empty_store(spark, fills=((2026, 1), (2026, 2))):
    return inc.Store(
        spark.createDataFrame([], MAP),
        spark.createDataFrame([(y, n, f"tbl{n}", 0, None, None) for y, n in fills], PART),
        spark.createDataFrame([(2026, "B", "complete"), (2027, "C", "partial")], "year int, base_id string, status string"),
        spark.createDataFrame([], "year int, table_id string, record_id string"),
    )


def kept(store):
    """The store with its tables computed, as a commit would leave them."""
    for t in ("mapping", "partitions", "target"):
        df = getattr(store, t)
        setattr(store, t, df.sparkSession.createDataFrame(df.collect(), df.schema))
    return store


def test_insert_then_skip_then_update(spark):
    none = lines(spark, 0)
    s, first = inc.run_incremental(lines(spark, 5), none, empty_store(spark), capacity=3)
    kept(s)
    assert (first.inserted, first.updated, first.skipped, first.new_watermark) == (5, 0, 0, "2026-07-04 10:00:00")
    assert sorted((r.partition_no, r.fill_count, r.first_source_key, r.last_source_key) for r in s.partitions.collect()) == [(1, 3, "1|0|1", "1|2|1"), (2, 2, "1|3|1", "1|4|1")]
    assert s.target.count() == 5
    s, again = inc.run_incremental(lines(spark, 5), none, s, capacity=3)
    assert (again.inserted, again.updated, again.skipped) == (0, 0, 5)
    kept(s)
    s, third = inc.run_incremental(lines(spark, 5, srp=2.0, at="2569-07-05 00:00:00.642"), none, s, capacity=3)
    assert (third.inserted, third.updated, third.skipped, third.new_watermark) == (0, 5, 0, "2026-07-05 00:00:00")
    assert s.target.count() == 5 and s.mapping.select("partition_no").distinct().count() == 2
    # the target holds what the source says, all fields of it
    rows = s.target.select("payload.*").collect()
    assert {r.SRP for r in rows} == {2.0} and {r.SellID for r in rows} == set(range(5)) and len(rows[0]) == 41


def recorder(folder, fail=()):
    """A gateway; its class stands in a function so that it travels to the workers whole."""

    class Recorder:
        """A gateway that writes each call as a file."""

        def __init__(self, folder, fail=()):
            self.folder, self.fail = folder, fail

        def _call(self, op, table_id, items):
            import json
            import os
            import uuid

            mark = f"{self.folder}/{op}-failed"
            if op in self.fail and not os.path.exists(mark):
                open(mark, "w").close()
                raise CallError(1254291)
            with open(f"{self.folder}/{uuid.uuid4().hex}.json", "w") as f:
                json.dump([op, table_id, items], f)

        def create(self, table_id, records):
            self._call("create", table_id, records)

        def update(self, table_id, records):
            self._call("update", table_id, records)

        def delete(self, table_id, record_ids):
            self._call("delete", table_id, record_ids)

        def calls(self):
            import json
            import pathlib

            return [json.loads(p.read_text()) for p in pathlib.Path(self.folder).glob("*.json")]

    return Recorder(folder, fail)


def test_gateway_gets_whole_records_by_table_and_tries_again(spark, tmp_path):
    import json

    gateway = recorder(str(tmp_path), fail=("create", "update"))
    store = empty_store(spark)
    store.gateway = gateway
    s, _ = inc.run_incremental(lines(spark, 5), lines(spark, 0), store, capacity=3)
    s, _ = inc.run_incremental(lines(spark, 1, srp=9.0, at="2569-07-05 00:00:00"), lines(spark, 0), kept(s), capacity=3)
    made = sorted((t, len(items)) for op, t, items in gateway.calls() if op == "create")
    assert made == [("tbl1", 3), ("tbl2", 2)]
    ((_, table, ((record, fields),)),) = [c for c in gateway.calls() if c[0] == "update"]
    got = json.loads(fields)
    assert table == "tbl1" and got["SRP"] == 9.0 and len(got) == 41 and got["CrTime"] == 1769878800000
    healed, _ = inc.heal(kept(inc.replace(s, target=s.target.where("table_id = 'tbl1'"))), inc.prepared(lines(spark, 5)))
    again = [json.loads(f)["SellID"] for op, t, items in gateway.calls() if op == "create" and t == "tbl2" for _, f in items]
    assert sorted(again) == [3, 3, 4, 4] and healed.target.where("payload.SRP is null").count() == 0


def test_a_run_that_breaks_off_is_repeated_from_the_last_commit(spark, tmp_path, monkeypatch):
    """A failure at any write of a commit leaves the last version; the repeat ends as an unbroken run does."""
    folder = StateFolder(spark, str(tmp_path / "state"))
    folder.save(empty_store(spark), 0)
    for step in range(1, 8):
        writes = []
        import pyspark.sql.readwriter as rw

        for name in ("parquet", "json"):
            original = getattr(rw.DataFrameWriter, name)

            def counted(self, *args, original=original, **kw):
                writes.append(1)
                if len(writes) == step:
                    raise OSError("lost")
                return original(self, *args, **kw)

            monkeypatch.setattr(rw.DataFrameWriter, name, counted)
        try:
            sweep_batch(folder, lines(spark, 4), 0, 3)
            ended = True
        except OSError:
            ended = False
        monkeypatch.undo()
        if ended:
            break
        assert folder.latest() == (0, None) and folder.load().mapping.count() == 0
    assert ended and step > 3
    assert folder.latest() == (1, "2026-07-04 10:00:00") and folder.load().mapping.count() == 4 and folder.load().target.select("payload.*").count() == 4


def test_commits_rewrite_touched_years_only_and_prune(spark, tmp_path):
    import pathlib

    folder = StateFolder(spark, str(tmp_path))
    fills = ((2025, 1), (2026, 1))
    store = empty_store(spark, fills)
    store.years = spark.createDataFrame([(2025, "A", "complete"), (2026, "B", "complete")], "year int, base_id string, status string")
    s, _ = inc.run_incremental(lines(spark, 3, year=2568).union(lines(spark, 3, first=10)), lines(spark, 0), store)
    s = folder.commit(s)
    for k in range(3):
        s, got = inc.run_incremental(lines(spark, 3, srp=5.0 + k, first=10, at=f"2569-07-0{5 + k} 00:00:00"), lines(spark, 0), s)
        assert got.updated == 3
        s = folder.commit(s)
    versions = {str(p.relative_to(tmp_path)) for p in pathlib.Path(tmp_path).glob("mapping/*/*")}
    assert versions == {"mapping/year=2025/v=0", "mapping/year=2026/v=2", "mapping/year=2026/v=3"}
    assert s.mapping.count() == 6 and {r.SRP for r in s.target.where("year = 2026").select("payload.SRP").collect()} == {7.0}
    s = folder.commit(inc.clear_year(s, 2025))
    assert s.mapping.count() == 3 and s.target.count() == 3 and folder.latest()[0] == 4


def test_empty_sweep_writes_nothing(spark):
    store = empty_store(spark)
    s, got = inc.run_incremental(lines(spark, 0), lines(spark, 0), store)
    assert s is store and got == inc.Summary(inc.SEED, inc.SEED)


def test_years_that_are_not_ready_pass_the_watermark(spark):
    rows = lines(spark, 1).union(lines(spark, 1, year=2570, at="2569-07-09 00:00:00", first=10)).union(lines(spark, 1, year=2558, first=20))
    _, got = inc.run_incremental(rows, rows.limit(0), empty_store(spark))
    assert (got.inserted, got.ignored_rows, got.ignored_years, got.new_watermark) == (1, 2, (2015, 2027), "2026-07-09 00:00:00")


def test_capacity_error_comes_before_any_write(spark):
    with pytest.raises(inc.CapacityError, match="no partition capacity left for year 2026: 1 of 7"):
        inc.run_incremental(lines(spark, 7), lines(spark, 0), empty_store(spark), capacity=3)


def test_active_job_blocks(spark):
    store = empty_store(spark)
    store.jobs = spark.createDataFrame([(1, "full_sync", "ready")], "id long, type string, status string")
    with pytest.raises(inc.Blocked):
        inc.run_incremental(lines(spark, 1), lines(spark, 0), store)


def test_backfill_skips_what_is_mapped(spark):
    s, _ = inc.run_incremental(lines(spark, 2), lines(spark, 0), empty_store(spark))
    s, got = inc.run_backfill(lines(spark, 4), None, 2026, kept(s))
    assert (got.inserted, got.skipped) == (2, 2) and s.watermark == "2026-07-04 10:00:00"


def test_clear_and_heal(spark):
    s, _ = inc.run_incremental(lines(spark, 3), lines(spark, 0), empty_store(spark))
    kept(s)
    lost = s.target.first().record_id
    s.target = s.target.where(f"record_id <> '{lost}'").unionByName(spark.createDataFrame([(2026, "tbl1", "stray")], "year int, table_id string, record_id string"), allowMissingColumns=True)
    healed, done = inc.heal(s, inc.prepared(lines(spark, 3)))
    assert [(r.orphans_deleted, r.recreated) for r in done.collect()] == [(1, 1)] and healed.target.count() == 3
    c = inc.clear_year(healed, 2026)
    assert c.mapping.count() == 0 and c.target.count() == 0 and c.partitions.agg({"fill_count": "sum"}).first()[0] == 0 and c.partitions.count() == 2


def test_stream_drains_and_replays(spark, tmp_path):
    src, folder = str(tmp_path / "src"), StateFolder(spark, str(tmp_path / "state"))
    folder.save(empty_store(spark), 0)
    lines(spark, 4).write.parquet(src)
    q = start(spark.readStream.schema(ROW).parquet(src), folder, str(tmp_path / "ck"), capacity=3)
    q.awaitTermination()
    assert folder.latest() == (1, "2026-07-04 10:00:00") and folder.load().mapping.count() == 4
    assert sweep_batch(folder, lines(spark, 9), 0, 3) is None  # the same batch again
    again = sweep_batch(folder, lines(spark, 4), 1, 3)
    assert (again.inserted, again.skipped) == (0, 4) and folder.load().target.count() == 4
