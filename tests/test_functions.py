from datetime import UTC, datetime

from pyspark.sql import functions as F

from syncweave.functions import eras, identity, names
from syncweave.schema import PAYLOAD, payload_schema, schema_drift, transform


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp() * 1000)


def test_crc32_check_value(spark):
    assert one(spark, "123456789", identity.crc32) == 0xCBF43926


def test_epoch_ms_vectors(spark):
    assert one(spark, "2569-05-14 14:12:43.573", eras.be_to_epoch_ms) == ms("2026-05-14T07:12:43.573")
    assert one(spark, "2569-01-01 00:00:00", eras.be_to_epoch_ms) == ms("2025-12-31T17:00:00")
    assert one(spark, "2569-05-14 14:12:43.57", eras.be_to_epoch_ms) == ms("2026-05-14T07:12:43.570")
    assert one(spark, "2569-05-14 14:12:43.5739", eras.be_to_epoch_ms) == ms("2026-05-14T07:12:43.573")
    assert one(spark, "not-a-date", eras.be_to_epoch_ms) is None
    assert one(spark, None, eras.be_to_epoch_ms) is None


def test_epoch_ms_is_the_same_in_every_session_zone(spark):
    want = {"2569-07-03 09:00:00": ms("2026-07-03T02:00:00"), "2569-05-14 14:12:43.573": ms("2026-05-14T07:12:43.573"), "2569-03-08 02:30:00": ms("2026-03-07T19:30:00"), "2569-07-03 24:00:00": None, "2569-13-01 00:00:00": None}
    rows = spark.createDataFrame([(t,) for t in want], "x string")
    try:
        for zone in ("UTC", "Asia/Bangkok", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = rows.select("x", eras.be_to_epoch_ms(F.col("x")).alias("y"), eras.epoch_ms_to_utc(eras.be_to_epoch_ms(F.col("x"))).alias("u")).collect()
            assert {r.x: r.y for r in got} == want, zone
            assert got[0].u == "2026-07-03 02:00:00", zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_integers_beyond_the_doubles(spark):
    big = 2**53 + 1
    rows = spark.createDataFrame([(big, str(big), "3.00", "x")], "SellID long, SellBranch string, NUMBER string, STATUS string")
    p = transform(rows).select("payload.*").first()
    assert (p.SellID, p.SellBranch, p.NUMBER, p.STATUS) == (big, big, 3, None)


def test_leap_days_follow_the_common_era(spark):
    assert one(spark, "2567-02-29 07:00:00", eras.be_to_epoch_ms) == ms("2024-02-29T00:00:00")
    assert one(spark, "2568-02-29 07:00:00", eras.be_to_epoch_ms) is None


def test_era_strings(spark):
    assert one(spark, "2569-07-08 20:58:00.642", eras.be_to_ce) == "2026-07-08 20:58:00.642"
    assert one(spark, "2026-07-08 20:58:00", eras.ce_to_be) == "2569-07-08 20:58:00"
    assert one(spark, "2569-07-08 20:58:00.642", eras.watermark) == "2026-07-08 20:58:00"
    assert one(spark, "2560-01-01 00:00:00", eras.cr_year) == 2017
    assert eras.be_year_bounds(2024) == ("2567-01-01 00:00:00", "2568-01-01 00:00:00")
    assert one(spark, "1778742763573", lambda c: eras.epoch_ms_to_utc(c.cast("long"))) == "2026-05-14 07:12:43"


def test_year_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([("2567-01-01 00:00:00",)], "CrTime string").write.parquet(path)
    plan = spark.read.parquet(path).where(eras.in_year(F.col("CrTime"), 2024))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(CrTime,2567-01-01 00:00:00)" in plan


def test_keys(spark):
    row = spark.createDataFrame([(114, 1008889, 2), (None, 1, 2)], "b long, s long, r long").select(identity.derive_key("b", "s", "r").alias("k")).collect()
    assert [r.k for r in row] == ["114|1008889|2", "null|1|2"]


def test_partition_names(spark):
    rows = spark.createDataFrame([("itec_001",), ("itec_1",), ("daily_01",), ("Table",), ("itec_000",), ("itec_251",)], "n string")
    assert [r.p for r in rows.select(names.parse_partition_no(F.col("n")).alias("p")).collect()] == [1, None, None, None, 0, 251]
    got = spark.createDataFrame([(1,), (1000,)], "n int").select(names.partition_name(F.col("n")).alias("p")).collect()
    assert [r.p for r in got] == ["itec_001", "itec_1000"]


def test_payload_has_41_fields(spark):
    assert len(PAYLOAD) == 41 and len(payload_schema().fields) == 41
    empty = transform(spark.createDataFrame([(1,)], "other int"), "other").first().payload
    assert len(empty) == 41 and all(v is None for v in empty)
    got = transform(spark.createDataFrame([("0.00", "3.00", "x")], "SRP string, NUMBER string, Product string")).first().payload
    assert (got["SRP"], got["NUMBER"], got["Product"]) == (0.0, 3, "x")


def test_fingerprint_writes_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(identity.canonical_json("x", "y").alias("j")).first().j == '{"x":"a","y":null}'


def test_schema_drift(spark):
    got = {(r.column_name, r.drift) for r in schema_drift(spark.createDataFrame([(1, 2)], "a int, c int"), ("a", "b")).collect()}
    assert got == {("b", "missing"), ("c", "extra")}


def test_era_classifier(spark):
    got = [one(spark, v, eras.classify_era) for v in ("2569-01-01", "2026-01-01", "0001-01-01", None, "abc")]
    assert got == ["BE", "CE", "unknown", "no_sample", "no_sample"]
