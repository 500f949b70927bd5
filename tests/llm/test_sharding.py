import zlib
from collections import defaultdict

from conftest import DATA

from llm import sharding as sh
from llm.session import table


def check(rows, n):
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))
    return sizes


def test_query(spark):
    rows = sh.op6_sharding(spark, DATA).collect()
    docs = {r.doc_id: r.text for r in table(spark, DATA, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    sizes = check(rows, 16)
    assert max(sizes.values()) - min(sizes.values()) <= 4 * max(r.size for r in rows)


def test_hot_values_are_split(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else 1, "same text", "hot", "en") for i in range(4000)], "doc_id long, text string, source string, lang string")
    sizes = check(sh.with_slots(sh.kd_leaves(df, 16)).collect(), 16)
    assert len(sizes) == 16 and max(sizes.values()) <= 1.05 * min(sizes.values())


def test_sizes_are_near_equal_for_any_number(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 as int)) AS text", "concat('s', id % 3) AS source", "'en' AS lang", "id AS size", "id AS node")
    for n in (1, 5, 7):
        sizes = check(sh.with_slots(sh.kd_leaves(df, n)).collect(), n)
        assert len(sizes) == n and max(sizes.values()) - min(sizes.values()) <= 200
    total = df.selectExpr("sum(length(text) + 1)").first()[0]
    assert len(check(sh.with_slots(sh.kd_leaves(df, target_bytes=total // 4 + 1)).collect(), 4)) == 4


def test_nulls_missing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, None), (2, "é"), (None, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in sh.with_slots(sh.kd_leaves(df, 2)).collect()}
    assert (rows[1].size, rows[1].text_crc32) == (1, 0) and (rows[2].size, rows[2].text_crc32) == (3, zlib.crc32("é".encode())) and rows[None].size == 1
    assert sh.with_slots(sh.kd_leaves(df.limit(0), 16)).count() == 0


def test_main_path_has_no_python(spark):
    plan = sh.op6_sharding(spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
