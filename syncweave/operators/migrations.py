"""Ordered schema migrations: statements of a file, and what is still to run."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def statements(sql: str) -> list[str]:
    """Statements between semicolons; comments from ``--`` to the end of a line go first."""
    return [s for s in (x.strip() for x in re.sub(r"--[^\n]*", "", sql).split(";")) if s]


def pending(available: DataFrame, applied: DataFrame) -> DataFrame:
    """available(filename) without what applied(filename) holds, in name order; only .sql files count."""
    files = available.where(F.col("filename").endswith(".sql")).select("filename").distinct()
    return files.join(applied.select("filename"), "filename", "left_anti").orderBy("filename")


def run_pending(available: DataFrame, applied: DataFrame, read: Callable[[str], str], execute: Callable[[str], object]) -> DataFrame:
    """Runs each pending file's statements and returns the ledger with it added; a failing file is not added."""
    done: list[tuple[str]] = []
    for row in pending(available, applied).collect():  # one row a migration
        for s in statements(read(row.filename)):
            execute(s)
        done.append((row.filename,))
    return applied.select("filename").unionByName(applied.sparkSession.createDataFrame(done, "filename string"))


