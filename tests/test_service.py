import pytest
from test_runs import empty_store, kept, lines

from syncweave.operators import migrations
from syncweave.plans import service as sv
from syncweave.plans.frames import NOW
from syncweave.sources import calls

JOBS = "id long, type string, year int, status string, attempts long, run_after timestamp_ntz, payload string"


def service(spark, n=4, rows=None):
    store = empty_store(spark)
    store.jobs = spark.createDataFrame(rows or [], JOBS)
    return sv.Service(store, lines(spark, n), lines(spark, 0), capacity=3, count=3)


def test_arguments(spark):
    s = service(spark)
    for year in ("2026", 2026.0, True, None):
        with pytest.raises(ValueError):
            s.full_status(year)
    with pytest.raises(ValueError):
        s.base_status(1999)
    with pytest.raises(ValueError):
        s.enqueue("hard_full_sync", 2026)
    with pytest.raises(ValueError):
        s.init_base(2026, " ", spark.createDataFrame([], "name string"))
    with pytest.raises(sv.NotFound):
        s.enqueue("full_sync", 2027)
    with pytest.raises(sv.NotFound):
        s.check(2030)
    assert s.health() == "ok"


def test_init_within_a_budget_then_the_rest(spark):
    s = service(spark)
    have = spark.createDataFrame([("itec_001",), ("Table",)], "name string")
    first = s.init_base(2028, "B8", have, budget=1).first()
    assert (first.existing, first.created, first.remaining, first.status) == (1, 1, 1, "partial")
    assert s.base_status(2028).first().existing == 2
    more = spark.createDataFrame([("itec_001",), ("itec_002",)], "name string")
    assert s.init_base(2028, "B8", more).first().status == "complete"
    assert s.base_status(2028).first().complete
    assert s.remove_partitions(2028, more, dry_run=True).count() == 2 and s.base_status(2028).first().existing == 3
    s.remove_partitions(2028, more)
    assert s.base_status(2028).first().existing == 1


def test_full_sync_job_then_check_and_heal(spark):
    s = service(spark)
    assert s.full_status(2026).first().status == "not_started"
    job = s.enqueue("full_sync", 2026).first()
    assert (job.id, job.status) == (1, "ready") and s.enqueue("full_sync", 2026).first().id == 1
    assert s.work(NOW) == (1, "done") and s.work(NOW) == (None, "idle")
    kept(s.store)
    assert s.store.mapping.count() == 4 and {r.status for r in s.check(2026).collect()} == {"ok"}
    s.store.target = s.store.target.where("record_id <> '" + s.store.target.first().record_id + "'")
    assert [(r.orphans_deleted, r.recreated) for r in s.heal(2026).collect()] == [(0, 1)]
    assert s.store.target.count() == 4


def test_hard_full_clears_and_enqueues(spark):
    s = service(spark)
    s.incremental()
    kept(s.store)
    s.enqueue("hard_full_sync", 2026, confirm=True)
    assert s.work(NOW)[1] == "done" and s.store.mapping.count() == 0
    assert s.full_status(2026).first().status == "ready"


def test_failures_and_unknown_types(spark):
    s = service(spark, n=9, rows=[(1, "full_sync", 2026, "ready", 5, None, '{"appId":"a","secret":"s"}'), (2, "odd", 2026, "ready", 0, None, "{}"), (3, "full_sync", 2026, "ready", 0, None, "{}")])
    assert s.work(NOW) == (1, "dead")  # nine rows into two partitions of three
    assert s.store.jobs.where("id = 1").first().payload == '{"appId":"a"}'
    assert s.work(NOW) == (2, "dead") and s.work(NOW) == (3, "ready")
    assert s.store.jobs.where("id = 3").first().attempts == 1 and s.store.mapping.count() == 0


def test_calls():
    waits, answers = [], [1254291, 1254290, None]

    def call():
        code = answers.pop(0)
        if code:
            raise calls.CallError(code)
        return "x"

    assert calls.retrying(call, sleep=waits.append) == "x" and waits == [0.5, 1.0]
    with pytest.raises(calls.CallError):
        calls.retrying(lambda: (_ for _ in ()).throw(calls.CallError(1)), sleep=waits.append)
    assert [len(b) for b in calls.batches(range(1200), calls.DELETE_BATCH)] == [500, 500, 200]
    paged = {None: ([1, 2], "a"), "a": ([3], None)}
    assert list(calls.pages(paged.__getitem__)) == [1, 2, 3]


def test_migrations(spark):
    assert migrations.statements("-- a; comment\nCREATE x; -- b;\nDROP y;\n") == ["CREATE x", "DROP y"]
    have = spark.createDataFrame([("002.sql",), ("001.sql",), ("notes.md",), ("003.sql",)], "filename string")
    done = spark.createDataFrame([("001.sql",)], "filename string")
    assert [r.filename for r in migrations.pending(have, done).collect()] == ["002.sql", "003.sql"]
    ran = []
    ledger = migrations.run_pending(have, done, lambda f: f"A {f}; B {f}", ran.append)
    assert ran == ["A 002.sql", "B 002.sql", "A 003.sql", "B 003.sql"] and ledger.count() == 3


def test_walks_stop_at_their_budget_and_go_on(spark):
    s = service(spark, 4)
    s.incremental()
    assert s.state("incremental").first().last_utime == "2026-07-04 10:00:00"
    one = lambda: [r.partition_no for r in s.check(2026, budget=1).collect()]
    assert [one(), one(), one()] == [[1], [2], [1]]
    assert s.state("full_sync_check:2026").first().checkpoint == '{"lastPartitionNo": 1}'
    s.store.target = s.store.target.limit(0)
    assert [(r.partition_no, r.recreated) for r in s.heal(2026, budget=1).collect()] == [(1, 3)] and s.store.target.count() == 3
    assert [(r.partition_no, r.recreated) for r in s.heal(2026, budget=1).collect()] == [(2, 1)] and s.store.target.where("payload.SRP = 1.0").count() == 4
    more = spark.createDataFrame([("itec_001",), ("itec_002",)], "name string")
    assert [r.partition_no for r in s.remove_partitions(2026, more, budget=1).collect()] == [1]
    assert s.store.mapping.count() == 1 and s.store.target.count() == 1


def test_service_over_a_folder(spark, tmp_path):
    from syncweave.plans.commit import StateFolder

    s = service(spark, 4)
    s.folder = StateFolder(spark, str(tmp_path))
    s.incremental()
    s.enqueue("clear_partitions", 2026, confirm=True)
    assert s.work(NOW) == (1, "done") and s.store.mapping.count() == 0
    again = sv.Service(s.folder.load(), s.history, s.today, capacity=3, count=3, folder=s.folder)
    assert again.store.jobs.first().status == "done" and again.store.partitions.agg({"fill_count": "sum"}).first()[0] == 0
