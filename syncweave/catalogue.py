"""Every operator as a named query over the star schema, with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncweave.functions import eras, identity, names
from syncweave.operators import changes, jobs, packing, provision, quality, reconcile, state
from syncweave.plans import frames as fr
from syncweave.schema import KEY, PAYLOAD, schema_drift, transform
from syncweave.sources import fact as sources
from syncweave.sources import target as targets
from syncweave.storage import checkpointed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# ---- the synthetic tables of plans.frames in SQL; a query gets those it names, in order --------------

_BE = "(year({0}) + 543)::VARCHAR || strftime({0}, '-%m-%d %H:%M:%S')"
_CTES = {
    "fact": f"""SELECT l_suppkey::BIGINT AS "SellBranch", l_orderkey::BIGINT AS "SellID", l_linenumber::BIGINT AS "RowNo",
        {_BE.format("l_shipdate")} AS "CrTime", {_BE.format("l_shipdate")} AS "UTime", l_partkey::BIGINT AS part, 'P' || l_partkey AS "Product",
        l_quantity::BIGINT AS "NUMBER", l_extendedprice::DECIMAL(18,2) AS "SRP", l_returnflag AS "Comment" FROM lineitem""",
    "latest": """SELECT * FROM fact QUALIFY row_number() OVER (PARTITION BY "SellBranch", "SellID", "RowNo" ORDER BY "UTime" DESC, part DESC) = 1""",
    "source": """SELECT *, substr("CrTime", 1, 4)::INT - 543 AS year, "SellBranch" || '|' || "SellID" || '|' || "RowNo" AS source_key,
        md5(concat_ws('|', "CrTime", "SellID", "SellBranch", "Product", "NUMBER", "SRP", "Comment")) AS checksum FROM latest""",
    "feed": """SELECT 1::BIGINT AS "SellBranch", user_id::BIGINT AS "SellID", (event_id % 7)::BIGINT AS "RowNo",
        (year(ts) + 543)::VARCHAR || strftime(ts, '-%m-%d %H:%M:%S') AS "CrTime", (year(ts) + 543)::VARCHAR || strftime(ts, '-%m-%d %H:%M:%S.%g') AS "UTime",
        event_id::BIGINT AS part, event_type AS "Product", day(ts) AS day FROM events""",
    "mapping": """SELECT year, 'base' || year AS base_id, source_key, ("SellID" % 40 + 1)::INT AS partition_no, 'tbl-' || year || '-' || ("SellID" % 40 + 1) AS table_id,
        'rec' || substr(md5(year || '|' || source_key), 1, 20) AS record_id, CASE WHEN "SellID" % 5 = 0 THEN 'old' || checksum ELSE checksum END AS checksum,
        (substr("CrTime", 1, 4)::INT - 543) || substr("CrTime", 5) AS cr_time, (substr("UTime", 1, 4)::INT - 543) || substr("UTime", 5) AS u_time, "SellID" AS sell
        FROM source WHERE "SellID" % 4 <> 0""",
    "years": "SELECT y::INT AS year, 'base' || y AS base_id, CASE WHEN y = 1998 THEN 'partial' ELSE 'complete' END AS status FROM range(1995, 2001) t(y)",
    "parts": """SELECT y::INT AS year, n::INT AS partition_no, 'tbl-' || y || '-' || n AS table_id, 'itec_' || lpad(n::VARCHAR, 3, '0') AS name,
        (CASE WHEN n <= 3 THEN 500 WHEN n = 4 THEN 480 WHEN n % 9 = 0 THEN 500 - n ELSE 0 END)::BIGINT AS fill_count, 'f' || n AS first_source_key, 'l' || n AS last_source_key
        FROM range(1995, 2002) t(y), range(1, 41) u(n)""",
    "tgt": """SELECT year, table_id, record_id FROM mapping WHERE sell % 50 <> 1 UNION ALL SELECT year, table_id, 'stray-' || record_id FROM mapping WHERE sell % 75 = 2""",
    "jobs": """SELECT i AS id, ['full_sync', 'hard_full_sync', 'clear_partitions'][(i % 3 + 1)::INT] AS type, (1995 + i % 5)::INT AS year,
        ['ready', 'claimed', 'done', 'dead'][(i % 4 + 1)::INT] AS status, (i % 7)::BIGINT AS attempts,
        TIMESTAMP '2026-07-10 12:00:00' + to_seconds((i - 30) * 60) AS run_after, '{"appId":"a' || i || '","secret":"s"}' AS payload FROM range(1, 61) t(i)""",
    "classified": """SELECT s.*, CASE WHEN y.year IS NULL THEN 'ignore' WHEN m.source_key IS NULL THEN 'insert' WHEN m.checksum <> s.checksum THEN 'update' ELSE 'skip' END AS action
        FROM source s LEFT JOIN mapping m ON m.year = s.year AND m.source_key = s.source_key LEFT JOIN (SELECT year FROM years WHERE status = 'complete') y ON y.year = s.year""",
    "need": "SELECT year, count(*) AS need FROM classified WHERE action = 'insert' GROUP BY year",
    "numbered": """SELECT year, source_key, "UTime", "SellID", "RowNo", "SellBranch", row_number() OVER (PARTITION BY year ORDER BY "UTime", "SellID", "RowNo", "SellBranch") AS rn FROM classified WHERE action = 'insert'""",
    "rooms": "SELECT *, 500 - fill_count AS room, sum(500 - fill_count) OVER (PARTITION BY year ORDER BY partition_no) AS hi FROM parts WHERE fill_count < 500",
    "segs": """SELECT r.year, r.partition_no, r.table_id, r.fill_count AS start_index, least(r.room, n.need - (r.hi - r.room))::BIGINT AS count, (r.hi - r.room)::BIGINT AS "offset"
        FROM rooms r JOIN need n ON n.year = r.year WHERE r.hi - r.room < n.need""",
    "slots": """SELECT n.year, n.source_key, s.partition_no, s.table_id, (s.start_index + n.rn - 1 - s."offset")::BIGINT AS slot
        FROM numbered n JOIN segs s ON s.year = n.year AND n.rn - 1 >= s."offset" AND n.rn - 1 < s."offset" + s.count""",
    "checked": """SELECT p.year, p.partition_no, p.table_id, p.fill_count, coalesce(m.n, 0)::BIGINT AS n_mapped, coalesce(t.n, 0)::BIGINT AS n_target,
        CASE WHEN coalesce(t.n, 0) <> coalesce(m.n, 0) THEN 'target_drift' WHEN p.fill_count <> coalesce(m.n, 0) THEN 'fill_count_drift' ELSE 'ok' END AS status
        FROM parts p LEFT JOIN (SELECT year, partition_no, count(*) AS n FROM mapping GROUP BY ALL) m ON m.year = p.year AND m.partition_no = p.partition_no
        LEFT JOIN (SELECT table_id, count(*) AS n FROM tgt GROUP BY ALL) t ON t.table_id = p.table_id""",
    "lost": "SELECT m.* FROM mapping m WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.table_id = m.table_id AND t.record_id = m.record_id)",
    "gone": "SELECT t.* FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE t.table_id = m.table_id AND t.record_id = m.record_id)",
    "alive": """SELECT * FROM source WHERE "SellID" % 100 <> 1""",
}
_NEEDS = {
    "latest": ["fact"], "source": ["latest"], "mapping": ["source"], "tgt": ["mapping"], "classified": ["source", "mapping", "years"], "need": ["classified"],
    "numbered": ["classified"], "rooms": ["parts"], "segs": ["rooms", "need"], "slots": ["numbered", "segs"], "checked": ["parts", "mapping", "tgt"],
    "lost": ["mapping", "tgt"], "gone": ["mapping", "tgt"], "alive": ["source"],
}


def _with(needs: str, sql: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in needs.split():
        add(n)
    return ("WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in order) + "\n" if order else "") + sql


def _query(needs: str = "", sql: str = ""):
    """Registers a function as a query, with its SQL over the named tables."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = _with(needs, sql)
        return f

    return keep


# ---- scalars --------------------------------------------------------------------------------------

K = '"SellBranch", "SellID", "RowNo"'


@_query("fact", f"""SELECT {K}, part, "SellBranch" || '|' || "SellID" || '|' || "RowNo" AS source_key FROM fact""")
def derive_key(spark, d):
    return fr.fact(spark, d).select(*KEY, "part", identity.derive_key(*KEY).alias("source_key"))


@_query("fact", f"""SELECT "SellBranch" AS branch, "SellID" AS sell_id, "RowNo" AS row_no, part FROM fact""")
def parse_key(spark, d):
    rows = fr.fact(spark, d).select(identity.derive_key(*KEY).alias("k"), "part")
    b, s, r = identity.parse_key(F.col("k"))
    return rows.select(b.alias("branch"), s.alias("sell_id"), r.alias("row_no"), "part")


@_query("", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_BE.format('l_shipdate')} AS be FROM lineitem")
def be_encode(spark, d):
    li = fr.read(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", eras.ce_to_be(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("be"))


@_query("", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_ms(l_shipdate - INTERVAL 7 HOUR) AS ms FROM lineitem")
def be_decode_epoch_ms(spark, d):
    return _li(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", eras.be_to_epoch_ms(F.col("be")).alias("ms"))


@_query("", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS utc FROM lineitem")
def epoch_ms_to_utc(spark, d):
    return _li(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", eras.epoch_ms_to_utc(eras.be_to_epoch_ms(F.col("be"))).alias("utc"))


@_query("", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ce FROM lineitem")
def be_to_ce(spark, d):
    return _li(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", eras.be_to_ce(F.col("be")).alias("ce"))


def _li(spark, d):
    return fr.read(spark, d, "lineitem").withColumn("be", fr.be_text(F.col("l_shipdate")))


@_query("", "SELECT y::INT AS year, (y + 543) || '-01-01 00:00:00' AS low, (y + 544) || '-01-01 00:00:00' AS high FROM range(1995, 2002) t(y)")
def be_year_bounds(spark, d):
    return spark.createDataFrame([(y, *eras.be_year_bounds(y)) for y in range(1995, 2002)], "year int, low string, high string")


@_query("fact", """SELECT count(*)::BIGINT AS n_rows FROM fact WHERE "CrTime" >= '2540-01-01 00:00:00' AND "CrTime" < '2541-01-01 00:00:00'""")
def be_year_range_count(spark, d):
    return sources.count_year(fr.fact(spark, d), 1997)


@_query("", "SELECT year(l_shipdate)::INT AS year, count(*)::BIGINT AS n_rows FROM lineitem GROUP BY ALL")
def cr_year_routing(spark, d):
    return _li(spark, d).groupBy(eras.cr_year(F.col("be")).alias("year")).agg(F.count("*").alias("n_rows"))


@_query("fact", f"""SELECT {K}, part, epoch_ms("CrTime_ts" - INTERVAL 7 HOUR) AS cr_ms, "Product" AS product, "NUMBER" AS number, "SRP"::DOUBLE AS srp, NULL::VARCHAR AS brand
    FROM (SELECT f.*, strptime((substr("CrTime", 1, 4)::INT - 543) || substr("CrTime", 5), '%Y-%m-%d %H:%M:%S') AS "CrTime_ts" FROM fact f)""")
def transform_payload(spark, d):
    p = transform(fr.fact(spark, d).withColumnsRenamed({k: f"k_{k}" for k in KEY}), *[f"k_{k}" for k in KEY], "part")
    cols = [("CrTime", "cr_ms"), ("Product", "product"), ("NUMBER", "number"), ("SRP", "srp"), ("Brand", "brand")]
    return p.select(*[F.col(f"k_{k}").alias(k) for k in KEY], "part", *[F.col(f"payload.{a}").alias(b) for a, b in cols])


@_query()
def fingerprint(spark, d):
    rows = fr.fact(spark, d)
    return rows.select(*KEY, "part", identity.fingerprint("CrTime", "SellID", "SellBranch", "Product", "NUMBER", "SRP", "Comment").alias("checksum"))


@_query("fact", f"""SELECT {K}, part, md5(concat_ws('|', "CrTime", "SellID", "SellBranch", "Product", "NUMBER", "SRP", "Comment")) AS checksum FROM fact""")
def fingerprint_md5(spark, d):
    return fr.fact(spark, d).select(*KEY, "part", fr.content("CrTime", "SellID", "SellBranch", "Product", "NUMBER", "SRP", "Comment").alias("checksum"))


@_query("", r"SELECT n::INT AS partition_no, 'itec_' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END AS name, CASE WHEN n < 1000 THEN n::INT END AS parsed FROM range(1, 1201) t(n)")
def partition_names(spark, d):
    rows = spark.range(1, 1201).select(F.col("id").cast("int").alias("partition_no")).withColumn("name", names.partition_name(F.col("partition_no")))
    return rows.withColumn("parsed", names.parse_partition_no(F.col("name")))


@_query("", """SELECT v AS era, count(*)::BIGINT AS n_rows FROM (SELECT CASE WHEN year(l_shipdate) + 543 BETWEEN 2400 AND 2700 THEN 'BE' END AS v FROM lineitem
    UNION ALL SELECT CASE WHEN year(o_orderdate) BETWEEN 1900 AND 2100 THEN 'CE' END FROM orders UNION ALL SELECT 'unknown' FROM region UNION ALL SELECT 'no_sample' FROM nation) GROUP BY v""")
def era_classifier(spark, d):
    text = _li(spark, d).select("be").union(fr.read(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd")))
    text = text.union(fr.read(spark, d, "region").select(F.lit("0001-01-01"))).union(fr.read(spark, d, "nation").select(F.lit("none")))
    return text.groupBy(eras.classify_era(F.col("be")).alias("era")).agg(F.count("*").alias("n_rows"))


@_query("parts", "SELECT year, partition_no, 500 - fill_count AS remaining, fill_count >= 500 AS is_full FROM parts")
def remaining_room(spark, d):
    cap = F.lit(fr.CAPACITY)
    return fr.partitions(spark).select("year", "partition_no", names.remaining(cap, F.col("fill_count")).alias("remaining"), names.is_full(cap, F.col("fill_count")).alias("is_full"))


# ---- scans ----------------------------------------------------------------------------------------


@_query("fact", f"""SELECT {K}, part FROM (SELECT * FROM latest_rows WHERE "CrTime" >= '2540-01-01 00:00:00' AND "CrTime" < '2541-01-01 00:00:00'
    AND ("SellID" > 500 OR ("SellID" = 500 AND ("RowNo" > 2 OR ("RowNo" = 2 AND "SellBranch" > 0)))) ORDER BY "SellID", "RowNo", "SellBranch" LIMIT 1000)""".replace("latest_rows", f"""(SELECT * FROM fact QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY "UTime" DESC, part DESC) = 1)"""))
def keyset_page(spark, d):
    return sources.chunk(sources.latest_per_key(fr.fact(spark, d), tie=("part",)), 1997, 1000, (500, 2, 0)).select(*KEY, "part")


_CHANGED = f"""SELECT * FROM (SELECT * FROM (SELECT *, 0 AS src FROM feed WHERE day < 29 UNION ALL SELECT *, 1 FROM feed WHERE day >= 28) WHERE "UTime" >= '2567-01-20 00:00:00')
    QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY "UTime" DESC, src, part DESC) = 1"""


@_query("feed", f'SELECT {K}, "CrTime", "UTime", part, "Product" FROM ({_CHANGED})')
def changed_since(spark, d):
    return sources.changed_since(*fr.feed(spark, d), "2024-01-20 00:00:00", tie=("part",))


@_query("latest", f'SELECT {K}, "UTime", part, "Product" FROM latest')
def latest_per_key(spark, d):
    return sources.latest_per_key(fr.fact(spark, d), tie=("part",)).select(*KEY, "UTime", "part", "Product")


@_query("source mapping", """SELECT source_key, part FROM source WHERE source_key IN (SELECT source_key FROM mapping)""")
def fetch_by_keys(spark, d):
    return sources.by_keys(fr.source(spark, d).drop("source_key"), fr.mapping(spark, d)).select("source_key", "part")


@_query("parts", "SELECT partition_no, table_id, fill_count FROM parts WHERE year = 1997")
def list_partitions(spark, d):
    return fr.partitions(spark).where("year = 1997").select("partition_no", "table_id", "fill_count").orderBy("partition_no")


@_query("mapping", "SELECT source_key, record_id FROM mapping WHERE year = 1997 AND partition_no = 6")
def mappings_for_partition(spark, d):
    return fr.mapping(spark, d).where("year = 1997 and partition_no = 6").select("source_key", "record_id")


@_query("years", "SELECT * FROM years WHERE year = 1998")
def get_year(spark, d):
    return fr.years(spark).where("year = 1998")


@_query("tgt", "SELECT table_id, count(*)::BIGINT AS n_target FROM tgt GROUP BY ALL")
def count_target(spark, d):
    return targets.count_records(fr.target(spark, d))


@_query("tgt", "SELECT table_id, record_id FROM tgt WHERE table_id = 'tbl-1997-6'")
def list_record_ids(spark, d):
    return targets.record_ids(fr.target(spark, d), "tbl-1997-6")


@_query("parts", "SELECT table_id, name FROM parts WHERE year = 1999")
def list_tables(spark, d):
    return targets.list_tables(fr.partitions(spark).where("year = 1999"))


# ---- changes --------------------------------------------------------------------------------------


@_query("classified", "SELECT year, source_key, checksum, action FROM classified")
def classify_changes(spark, d):
    return changes.classify(fr.source(spark, d), fr.mapping(spark, d), fr.years(spark)).select("year", "source_key", "checksum", "action")


@_query("classified", """SELECT count(*)::BIGINT AS scanned, count_if(action = 'insert')::BIGINT AS inserted, count_if(action = 'update')::BIGINT AS updated,
    count_if(action = 'skip')::BIGINT AS skipped, count_if(action = 'ignore')::BIGINT AS ignored_rows,
    (SELECT string_agg(DISTINCT year::VARCHAR, ',' ORDER BY year::VARCHAR) FROM classified WHERE action = 'ignore') AS ignored_years FROM classified""")
def change_counters(spark, d):
    got = changes.counters(changes.classify(fr.source(spark, d), fr.mapping(spark, d), fr.years(spark)))
    return got.withColumn("ignored_years", F.array_join("ignored_years", ","))


@_query("source years", "SELECT year, count(*)::BIGINT AS ignored_rows FROM source WHERE year NOT IN (SELECT year FROM years WHERE status = 'complete') GROUP BY ALL")
def ignored_years(spark, d):
    return changes.split_ready(fr.source(spark, d), fr.years(spark))[1].groupBy("year").agg(F.count("*").alias("ignored_rows"))


@_query("feed", """SELECT strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S') AS new_watermark FROM events""")
def next_watermark(spark, d):
    history, today = fr.feed(spark, d)
    return changes.next_watermark(history.unionByName(today), "2026-07-03 00:00:00")


@_query("numbered", "SELECT year, source_key, rn::INT AS rn, ((rn - 1) // 1000)::BIGINT AS batch FROM numbered")
def batch_ordinals(spark, d):
    return changes.batch_ordinals(_inserts(spark, d), ["UTime", "SellID", "RowNo", "SellBranch"]).select("year", "source_key", "rn", "batch")


def _inserts(spark, d):
    classified = changes.classify(fr.source(spark, d), fr.mapping(spark, d), fr.years(spark))
    return classified.where("action = 'insert'").drop("partition_no", "table_id", "record_id")


# ---- packing --------------------------------------------------------------------------------------


def _segments(spark, d, new):
    return packing.segments(fr.partitions(spark), new.groupBy("year").agg(F.count("*").alias("need")), fr.CAPACITY)


@_query("segs", "SELECT * FROM segs")
def reserve_slots(spark, d):
    return _segments(spark, d, _inserts(spark, d))


def _slots(spark, d, wide=False):
    new = checkpointed(_inserts(spark, d))  # needed for the counts and for the rows
    return packing.assign_slots(packing.number_rows(new, ["UTime", "SellID", "RowNo", "SellBranch"], wide=wide), _segments(spark, d, new))


@_query("slots", "SELECT * FROM slots")
def slot_assignment(spark, d):
    return _slots(spark, d).select("year", "source_key", "partition_no", "table_id", "slot")


@_query("slots", "SELECT * FROM slots")
def slot_assignment_wide(spark, d):
    """The same slots, numbered by ranges of the whole order: no task sorts a year alone."""
    return _slots(spark, d, wide=True).select("year", "source_key", "partition_no", "table_id", "slot")


@_query("tgt classified mapping slots", """SELECT t.table_id, t.record_id, u."Product" AS product FROM tgt t LEFT JOIN
    (SELECT m.table_id, m.record_id, c."Product" FROM classified c JOIN mapping m ON m.year = c.year AND m.source_key = c.source_key WHERE c.action = 'update') u
    ON u.table_id = t.table_id AND u.record_id = t.record_id UNION ALL
    SELECT s.table_id, 'rec' || substr(md5(s.year || '|' || s.source_key), 1, 20), c."Product" FROM slots s JOIN classified c ON c.year = s.year AND c.source_key = s.source_key""")
def sweep_target(spark, d):
    """The target's records after a sweep: inserts and updates with their payload."""
    classified = checkpointed(changes.classify(fr.source(spark, d), fr.mapping(spark, d), fr.years(spark)))
    record = ["table_id", "record_id", F.col("Product").alias("product")]
    new = classified.where("action = 'insert'").drop("partition_no", "table_id", "record_id")
    placed = packing.assign_slots(packing.number_rows(new, ["UTime", "SellID", "RowNo", "SellBranch"]), _segments(spark, d, new))
    made = targets.create_records(fr.target(spark, d), placed.withColumn("record_id", identity.record_id(F.col("year"), F.col("source_key"))).select("year", *record))
    return targets.update_records(made, classified.where("action = 'update'").select(*record)).select("table_id", "record_id", "product")


@_query("slots", """SELECT year, partition_no, max(CASE WHEN slot = 0 THEN source_key END) AS first_source_key, arg_max(source_key, slot) AS last_source_key, max(slot) AS last_slot FROM slots GROUP BY year, partition_no""")
def partition_boundaries(spark, d):
    return packing.boundaries(_slots(spark, d))


@_query("parts", "SELECT year, min(partition_no) AS partition_no, arg_min(table_id, partition_no) AS table_id, arg_min(fill_count, partition_no) AS fill_count FROM parts WHERE fill_count < 500 GROUP BY year")
def open_partition(spark, d):
    return packing.open_partition(fr.partitions(spark), fr.CAPACITY)


@_query("parts need", """SELECT n.year, n.need, (n.need - r.room)::BIGINT AS missing FROM need n JOIN (SELECT year, sum(greatest(0, 490 - fill_count)) AS room FROM parts WHERE partition_no <= 4 GROUP BY year) r ON r.year = n.year WHERE n.need > r.room""")
def capacity_shortfall(spark, d):
    need = _inserts(spark, d).groupBy("year").agg(F.count("*").alias("need"))
    return packing.shortfalls(fr.partitions(spark).where("partition_no <= 4"), need, 490)


@_query("parts tgt", """SELECT p.year, p.partition_no, (CASE WHEN p.partition_no = 4 THEN least(p.fill_count, coalesce(t.n, 0)) ELSE p.fill_count END)::BIGINT AS fill_count
    FROM parts p LEFT JOIN (SELECT table_id, count(*) AS n FROM tgt GROUP BY ALL) t ON t.table_id = p.table_id""")
def fill_correction(spark, d):
    fixed = packing.correct_fill(fr.partitions(spark), targets.count_records(fr.target(spark, d)), fr.CAPACITY)
    return fixed.select("year", "partition_no", "fill_count")


# ---- reconciliation -------------------------------------------------------------------------------


def _checked(spark, d):
    return reconcile.check_partitions(fr.partitions(spark), fr.mapping(spark, d), fr.target(spark, d))


@_query("checked", "SELECT * FROM checked")
def check_partitions(spark, d):
    return _checked(spark, d)


@_query("checked source", """SELECT c.year, count(*)::BIGINT AS partitions_checked, sum(n_mapped)::BIGINT AS mapped_total, sum(n_target)::BIGINT AS target_total,
    count_if(status <> 'ok')::BIGINT AS findings, coalesce(any_value(s.n), 0)::BIGINT AS n_source, sum(n_mapped) < coalesce(any_value(s.n), 0) AS backfill_incomplete
    FROM checked c LEFT JOIN (SELECT year, count(*) AS n FROM source GROUP BY year) s ON s.year = c.year GROUP BY c.year""")
def check_summary(spark, d):
    counts = fr.source(spark, d).groupBy("year").agg(F.count("*").alias("n_source"))
    return reconcile.check_summary(_checked(spark, d), counts)


@_query("gone", "SELECT year, table_id, record_id FROM gone")
def heal_orphans(spark, d):
    return reconcile.orphans(fr.target(spark, d), fr.mapping(spark, d)).select("year", "table_id", "record_id")


def _missing(spark, d):
    return reconcile.missing(fr.mapping(spark, d), fr.target(spark, d))


def _alive(spark, d):
    return fr.source(spark, d).where("SellID % 100 <> 1")


@_query("lost", "SELECT year, source_key, table_id, record_id FROM lost")
def heal_missing(spark, d):
    return _missing(spark, d).select("year", "source_key", "table_id", "record_id")


@_query("lost alive", "SELECT source_key, record_id FROM lost WHERE source_key IN (SELECT source_key FROM alive)")
def heal_recreate(spark, d):
    return reconcile.recreate(_missing(spark, d), _alive(spark, d)).select("source_key", "record_id")


@_query("lost alive", "SELECT source_key, record_id FROM lost WHERE source_key NOT IN (SELECT source_key FROM alive)")
def heal_unrecoverable(spark, d):
    return reconcile.unrecoverable(_missing(spark, d), _alive(spark, d)).select("source_key", "record_id")


@_query("parts gone lost alive", """SELECT * FROM (SELECT p.year, p.partition_no, p.table_id, coalesce(g.n, 0)::BIGINT AS orphans_deleted, coalesce(r.n, 0)::BIGINT AS recreated FROM parts p
    LEFT JOIN (SELECT table_id, count(*) AS n FROM gone GROUP BY ALL) g ON g.table_id = p.table_id
    LEFT JOIN (SELECT table_id, count(*) AS n FROM lost WHERE source_key IN (SELECT source_key FROM alive) GROUP BY ALL) r ON r.table_id = p.table_id) WHERE orphans_deleted > 0 OR recreated > 0""")
def heal_actions(spark, d):
    return reconcile.heal_actions(fr.partitions(spark), fr.mapping(spark, d), fr.target(spark, d), _alive(spark, d))


@_query("mapping alive", "SELECT year, source_key FROM mapping WHERE source_key NOT IN (SELECT source_key FROM alive)")
def deleted_in_source(spark, d):
    return reconcile.deleted_in_source(fr.mapping(spark, d), _alive(spark, d)).select("year", "source_key")


@_query("mapping source", "SELECT s.year, s.source_key, s.checksum, m.checksum AS mapped_checksum FROM source s JOIN mapping m ON m.year = s.year AND m.source_key = s.source_key WHERE m.checksum <> s.checksum")
def source_drift(spark, d):
    return reconcile.source_drift(fr.source(spark, d), fr.mapping(spark, d))


# ---- state ----------------------------------------------------------------------------------------


def _news(spark, d):
    """Mappings of every third sell id, written anew, with keys that the store does not have."""
    s = fr.source(spark, d).where("SellID % 3 = 0")
    return s.select("year", F.lit("new").alias("base_id"), "source_key", F.lit(99).alias("partition_no"), F.lit("tbl-new").alias("table_id"), F.lit("rec-new").alias("record_id"), "checksum", F.lit("now").alias("cr_time"), F.lit("now").alias("u_time"))


@_query("mapping source", """SELECT coalesce(m.year, n.year) AS year, coalesce(m.source_key, n.source_key) AS source_key, coalesce(m.base_id, 'new') AS base_id, coalesce(m.cr_time, 'now') AS cr_time,
    CASE WHEN n.source_key IS NULL THEN m.partition_no ELSE 99 END AS partition_no, CASE WHEN n.source_key IS NULL THEN m.checksum ELSE n.checksum END AS checksum,
    CASE WHEN n.source_key IS NULL THEN m.u_time ELSE 'now' END AS u_time FROM mapping m FULL JOIN (SELECT * FROM source WHERE "SellID" % 3 = 0) n ON n.year = m.year AND n.source_key = m.source_key""")
def upsert_mapping(spark, d):
    return state.upsert_mapping(fr.mapping(spark, d), _news(spark, d)).select("year", "source_key", "base_id", "cr_time", "partition_no", "checksum", "u_time")


@_query("", """SELECT scope, coalesce(n_utime, utime) AS last_utime, coalesce(n_status, status) AS status FROM (SELECT coalesce(o.scope, n.scope) AS scope, o.utime, o.status, n.utime AS n_utime, n.status AS n_status FROM
    (SELECT 's' || n_nationkey AS scope, CASE WHEN n_nationkey % 2 = 0 THEN 'old' END AS utime, 'idle' AS status FROM nation) o
    FULL JOIN (SELECT 's' || (n_nationkey + 5) AS scope, CASE WHEN n_nationkey % 3 = 0 THEN 'new' END AS utime, CASE WHEN n_nationkey % 4 = 0 THEN 'busy' END AS status FROM nation) n ON n.scope = o.scope)""")
def patch_state(spark, d):
    n = F.col("n_nationkey")
    nation = fr.read(spark, d, "nation")
    old = nation.select(F.concat(F.lit("s"), n.cast("string")).alias("scope"), F.when(n % 2 == 0, "old").alias("last_utime"), F.lit("idle").alias("status"))
    new = nation.select(F.concat(F.lit("s"), (n + 5).cast("string")).alias("scope"), F.when(n % 3 == 0, "new").alias("last_utime"), F.when(n % 4 == 0, "busy").alias("status"))
    return state.patch(old, new, ["scope"])


def _states(spark, d):
    """A scope for each nation; the walks of some stand at a partition."""
    n = F.col("n_nationkey")
    at = F.when(n % 3 == 0, F.concat(F.lit('{"lastPartitionNo": '), (n % 41).cast("string"), F.lit("}")))
    return fr.read(spark, d, "nation").select(F.concat(F.lit("full_sync_check:"), n.cast("string")).alias("scope"), at.alias("checkpoint"), F.when(n % 2 == 0, "idle").alias("status"))


_STATES = """(SELECT 'full_sync_check:' || n_nationkey AS scope, CASE WHEN n_nationkey % 3 = 0 THEN '{"lastPartitionNo": ' || (n_nationkey % 41) || '}' END AS checkpoint,
    CASE WHEN n_nationkey % 2 = 0 THEN 'idle' END AS status FROM nation)"""


@_query("", f"SELECT * FROM {_STATES} WHERE scope IN ('full_sync_check:7', 'full_sync_check:9')")
def get_state(spark, d):
    return state.get_state(_states(spark, d), "full_sync_check:7", "full_sync_check:9")


@_query("", f"SELECT scope, status FROM {_STATES} WHERE scope <> 'full_sync_check:7'")
def clear_state(spark, d):
    return state.clear_state(_states(spark, d), "full_sync_check:7").select("scope", "status")


@_query("parts", f"""SELECT partition_no, table_id FROM parts WHERE year = 1997 AND partition_no > (SELECT coalesce(max((checkpoint->>'$.lastPartitionNo')::INT), 0) FROM {_STATES} WHERE scope = 'full_sync_check:9')
    ORDER BY partition_no LIMIT 5""")
def resume_walk(spark, d):
    """The five partitions after a walk's checkpoint."""
    after = state.last_partition(_states(spark, d), "full_sync_check:9").first().after
    return state.walk(fr.partitions(spark).where("year = 1997"), after, 5).select("partition_no", "table_id")


@_query("mapping", "SELECT year, source_key FROM mapping WHERE NOT (year = 1997 AND partition_no BETWEEN 1 AND 9)")
def delete_partitions_mapping(spark, d):
    gone = fr.partitions(spark).where("year = 1997 and partition_no between 1 and 9")
    return state.delete_partitions(fr.mapping(spark, d), gone).select("year", "source_key")


@_query("parts", "SELECT year, partition_no, table_id, CASE WHEN year = 1997 THEN 0 ELSE fill_count END AS fill_count, CASE WHEN year <> 1997 THEN first_source_key END AS first_source_key FROM parts")
def reset_partitions(spark, d):
    return state.reset_partitions(fr.partitions(spark), 1997).select("year", "partition_no", "table_id", "fill_count", "first_source_key")


@_query("mapping", "SELECT year, count(*)::BIGINT AS n_mapped FROM mapping WHERE year <> 1997 GROUP BY ALL")
def clear_year(spark, d):
    return state.delete_years(fr.mapping(spark, d), 1997).groupBy("year").agg(F.count("*").alias("n_mapped"))


@_query("parts slots", """SELECT p.year, p.partition_no, coalesce(s.f, p.first_source_key) AS first_source_key, coalesce(s.l, p.last_source_key) AS last_source_key FROM parts p LEFT JOIN
    (SELECT year, partition_no, max(CASE WHEN slot = 0 THEN source_key END) AS f, arg_max(source_key, slot) AS l FROM slots GROUP BY ALL) s ON s.year = p.year AND s.partition_no = p.partition_no""")
def update_boundaries(spark, d):
    done = state.update_boundaries(fr.partitions(spark), packing.boundaries(_slots(spark, d)))
    return done.select("year", "partition_no", "first_source_key", "last_source_key")


@_query("parts mapping", "SELECT p.year, p.partition_no, coalesce(m.n, 0)::BIGINT AS fill_count FROM parts p LEFT JOIN (SELECT year, partition_no, count(*) AS n FROM mapping GROUP BY ALL) m ON m.year = p.year AND m.partition_no = p.partition_no")
def set_fill_count(spark, d):
    return state.set_fill(fr.partitions(spark), fr.mapping(spark, d)).select("year", "partition_no", "fill_count")


@_query("tgt gone", "SELECT year, count(*)::BIGINT AS n_kept FROM tgt WHERE record_id NOT LIKE 'stray-%' GROUP BY year")
def delete_orphans(spark, d):
    t = fr.target(spark, d)
    return targets.delete_records(t, reconcile.orphans(t, fr.mapping(spark, d))).groupBy("year").agg(F.count("*").alias("n_kept"))


# ---- provisioning ---------------------------------------------------------------------------------


def _existing(spark):
    """Some names of partitions, and names that are none."""
    some = spark.range(1, 300).where("id % 3 <> 0").select(names.partition_name(F.col("id")).alias("name"))
    return some.union(spark.sql("SELECT * FROM VALUES ('Table'), ('daily_01'), ('itec_1') AS t(name)"))


_EXISTING = "(SELECT n FROM range(1, 300) t(n) WHERE n % 3 <> 0)"


@_query("", f"SELECT n::INT AS partition_no, 'itec_' || lpad(n::VARCHAR, 3, '0') AS name FROM range(1, 251) t(n) WHERE n NOT IN (SELECT n FROM {_EXISTING})")
def provision_diff(spark, d):
    return provision.to_create(_existing(spark))


@_query("", f"SELECT count(*)::BIGINT AS existing, 50::BIGINT AS created, (250 - count(*) - 50)::BIGINT AS remaining, 'partial' AS status FROM {_EXISTING} WHERE n <= 250")
def provision_status(spark, d):
    return provision.provision_status(_existing(spark), budget=50)


@_query("", f"SELECT 'itec_' || lpad(n::VARCHAR, 3, '0') AS name, n::INT AS partition_no FROM {_EXISTING} WHERE n <= 250")
def remove_partitions(spark, d):
    return provision.removable(_existing(spark))


@_query("years parts", "SELECT y.year, y.base_id, y.status, count(p.partition_no)::BIGINT AS existing, (250 - count(p.partition_no))::BIGINT AS missing, count(p.partition_no) = 250 AS complete FROM years y LEFT JOIN parts p ON p.year = y.year GROUP BY ALL")
def base_status(spark, d):
    return provision.base_status(fr.years(spark), fr.partitions(spark))


# ---- queue ----------------------------------------------------------------------------------------


@_query("jobs", "SELECT id, type, year FROM jobs WHERE status = 'ready' AND run_after <= TIMESTAMP '2026-07-10 12:00:00' ORDER BY id LIMIT 3")
def queue_claimable(spark, d):
    return jobs.claimable(fr.jobs(spark), fr.NOW, 3).select("id", "type", "year")


@_query("jobs", """SELECT id, CASE WHEN status = 'claimed' AND attempts >= 5 THEN 'dead' WHEN status = 'claimed' THEN 'ready' ELSE status END AS status,
    CASE WHEN status = 'claimed' AND attempts < 5 THEN attempts + 1 ELSE attempts END AS attempts,
    strftime(CASE WHEN status = 'claimed' AND attempts < 5 THEN TIMESTAMP '2026-07-10 12:01:00' ELSE run_after END, '%Y-%m-%d %H:%M:%S') AS run_after FROM jobs""")
def queue_after_failure(spark, d):
    return jobs.after_failure(fr.jobs(spark), fr.NOW).select("id", "status", "attempts", F.date_format("run_after", "yyyy-MM-dd HH:mm:ss").alias("run_after"))


@_query("jobs", "SELECT id, type, year, status FROM jobs WHERE status IN ('ready', 'claimed') AND type IN ('full_sync', 'clear_partitions')")
def active_blockers(spark, d):
    return jobs.active(fr.jobs(spark), ("full_sync", "clear_partitions")).select("id", "type", "year", "status")


@_query("jobs", "SELECT type, year, min(id) AS id FROM jobs WHERE status IN ('ready', 'claimed') GROUP BY type, year")
def queue_oldest_active(spark, d):
    return jobs.oldest_active(fr.jobs(spark))


@_query("jobs years", """SELECT y.year, max(j.id) AS id, coalesce(arg_max(j.status, j.id), 'not_started') AS status, coalesce(arg_max(j.attempts, j.id), 0)::BIGINT AS attempts
    FROM years y LEFT JOIN jobs j ON j.year = y.year AND j.type = 'full_sync' GROUP BY y.year""")
def queue_latest(spark, d):
    return jobs.latest(fr.jobs(spark), fr.years(spark), "full_sync")


@_query("jobs", """SELECT id, CASE WHEN status IN ('done', 'dead') THEN '{"appId":"a' || id || '"}' ELSE payload END AS payload FROM jobs""")
def queue_scrub(spark, d):
    return jobs.scrub(fr.jobs(spark)).select("id", "payload")


@_query("jobs years", """SELECT 60 + row_number() OVER (ORDER BY year) AS id, year FROM years WHERE status = 'complete' AND year NOT IN (SELECT year FROM jobs WHERE type = 'full_sync' AND status IN ('ready', 'claimed') AND id > 40)""")
def queue_enqueue(spark, d):
    queue = fr.jobs(spark).where("id > 40")
    return jobs.enqueue(queue, fr.years(spark), "full_sync", fr.years(spark).select("year")).where("id > 60").select("id", "year")


# ---- quality --------------------------------------------------------------------------------------


@_query("fact", f"SELECT {K}, count(*)::BIGINT AS n_rows FROM fact GROUP BY ALL HAVING count(*) > 1")
def identity_duplicates(spark, d):
    return quality.duplicates(fr.fact(spark, d))


@_query("fact", """SELECT "SellID", count(*)::BIGINT AS n_rows, count(DISTINCT "RowNo")::BIGINT AS n_row_nos, count(DISTINCT "SellBranch")::BIGINT AS n_branches FROM fact GROUP BY ALL
    HAVING count(DISTINCT "RowNo") > 1 OR count(DISTINCT "SellBranch") > 1""")
def identity_profile(spark, d):
    return quality.identity_profile(fr.fact(spark, d))


_ACTUAL = ["SellBranch", "SellID", "RowNo", "CrTime", "UTime", "part", "Product", "NUMBER", "SRP", "Comment"]
_LIST = lambda names: "(SELECT unnest([" + ", ".join(f"'{n}'" for n in names) + "]) AS column_name)"
_DECLARED = [*[f.name for f in PAYLOAD], "RowNo"]


@_query("", f"""SELECT column_name, 'missing' AS drift FROM {_LIST(_DECLARED)} WHERE column_name NOT IN {_LIST(_ACTUAL)}
    UNION ALL SELECT column_name, 'extra' FROM {_LIST(_ACTUAL)} WHERE column_name NOT IN {_LIST(_DECLARED)}""")
def schema_differences(spark, d):
    return schema_drift(fr.fact(spark, d))


@_query()
def preflight(spark, d):
    return quality.preflight(fr.fact(spark, d), None)


# ---- target, migrations and schema ----------------------------------------------------------------


@_query("tgt lost alive", """SELECT table_id, count(*)::BIGINT AS n_records FROM (SELECT table_id, record_id FROM tgt UNION SELECT table_id, record_id FROM lost WHERE source_key IN (SELECT source_key FROM alive)) GROUP BY table_id""")
def create_records(spark, d):
    back = reconcile.recreate(_missing(spark, d), _alive(spark, d)).select("year", "table_id", "record_id")
    return targets.create_records(fr.target(spark, d), back).groupBy("table_id").agg(F.count("*").alias("n_records"))


@_query("tgt mapping", """SELECT t.table_id, t.record_id, CASE WHEN m.record_id IS NULL THEN 'old' ELSE m.checksum END AS checksum FROM tgt t LEFT JOIN (SELECT * FROM mapping WHERE partition_no = 6) m ON m.table_id = t.table_id AND m.record_id = t.record_id""")
def update_records(spark, d):
    new = fr.mapping(spark, d).where("partition_no = 6").select("table_id", "record_id", "checksum")
    return targets.update_records(fr.target(spark, d).withColumn("checksum", F.lit("old")), new).select("table_id", "record_id", "checksum")


@_query("", "SELECT printf('%03d_step.sql', n) AS filename FROM range(1, 41) t(n) WHERE n % 3 <> 0")
def pending_migrations(spark, d):
    from syncweave.operators import migrations

    files = spark.range(1, 41).select(F.format_string("%03d_step.sql", F.col("id")).alias("filename"), "id")
    return migrations.pending(files.select("filename").union(spark.sql("SELECT 'notes.md'")), files.where("id % 3 = 0"))


@_query("", "SELECT unnest(['SellBranch', 'SellID', 'RowNo', 'CrTime', 'UTime', 'part', 'Product', 'NUMBER', 'SRP', 'Comment']) AS field")
def list_fields(spark, d):
    return spark.createDataFrame([(f,) for f in fr.fact(spark, d).schema.fieldNames()], "field string")


@_query("latest mapping years", """SELECT 'CE' AS era, count(*)::BIGINT AS n_rows FROM mapping WHERE cr_time >= '1900' AND cr_time < '2100'""")
def mapping_eras(spark, d):
    return fr.mapping(spark, d).groupBy(eras.classify_era(F.col("cr_time")).alias("era")).agg(F.count("*").alias("n_rows"))
