"""Data-quality checks of a source before it is synchronised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncweave.functions import eras
from syncweave.schema import KEY, PAYLOAD, schema_drift


def duplicates(fact: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return fact.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def identity_profile(fact: DataFrame) -> DataFrame:
    """Bills with their rows, distinct row numbers and distinct branches, where a bill has several of either."""
    per = fact.groupBy("SellID").agg(F.count("*").alias("n_rows"), F.count_distinct("RowNo").alias("n_row_nos"), F.count_distinct("SellBranch").alias("n_branches"))
    return per.where("n_row_nos > 1 or n_branches > 1")


def preflight(history: DataFrame, today: DataFrame | None, key: Sequence[str] = KEY) -> DataFrame:
    """(check_no, name, status, detail): FAIL stops a run, WARN does not."""
    spark = history.sparkSession
    out: list[tuple[int, str, str, str]] = []
    for no, (name, df) in enumerate((("history_columns", history), ("today_columns", today)), 1):
        if df is None:
            out.append((no, name, "FAIL", "the table is missing"))
            continue
        drift = schema_drift(df).groupBy("drift").agg(F.array_sort(F.collect_list("column_name")).alias("c"))
        found = {r.drift: r.c for r in drift.collect()}  # at most the number of columns
        status = "FAIL" if found.get("missing") else "WARN" if found.get("extra") else "PASS"
        out.append((no, name, status, f"missing {found.get('missing', [])}, extra {found.get('extra', [])}"))
    kinds = {f.name: f for f in PAYLOAD}
    wrong = sorted(f.name for f in history.schema.fields if f.name in kinds and kinds[f.name].logical == "datetime" and f.dataType.simpleString() != "string")
    out.append((3, "datetimes_are_text", "FAIL" if wrong else "PASS", f"not text: {wrong}"))
    lacks = [k for k in key if k not in history.columns]
    out.append((4, "identity_columns", "FAIL" if lacks else "PASS", f"missing {lacks}"))
    sample = history.where(F.col("CrTime").isNotNull()).select(eras.classify_era(F.col("CrTime")).alias("e")).limit(1).collect() if "CrTime" in history.columns else []
    era = sample[0].e if sample else "no_sample"
    out.append((5, "era", "PASS" if era == "BE" else "WARN" if era == "no_sample" else "FAIL", era))
    if not lacks:
        one = duplicates(history, key).limit(1).count()
        out.append((6, "identity_unique", "FAIL" if one else "PASS", "a key occurs twice" if one else ""))
        nulls = history.where(" or ".join(f"`{k}` is null" for k in key)).limit(1).count()
        out.append((7, "identity_not_null", "FAIL" if nulls else "PASS", "a key part is null" if nulls else ""))
    return spark.createDataFrame(out, "check_no int, name string, status string, detail string")


def exit_code(checks: DataFrame) -> int:
    return int(checks.where(F.col("status") == "FAIL").limit(1).count() > 0)
