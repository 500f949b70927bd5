"""Line de-duplication on overlapping three-line windows.

Every run of three consecutive lines is hashed (two 64-bit values).  Of the windows that occur more
than once anywhere, the first occurrence, in the order of (doc_id, text hash, position), stays; each
later one covers its three lines.  The covered positions of a document are merged and removed.

Defined results: lines are split at ``\\n`` only and compared exactly; windows of three blank lines do
not count; texts of fewer than three lines stay whole; a null text stays null with n_lines 0; rows equal
in doc_id and text are treated alike; a null doc_id sorts after all others; an empty table gives an empty
table; other columns are carried along unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.session import materialise, table

WINDOW = 3
_ROW = ["nul", "id", "th"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {
            "nul": F.col("doc_id").isNull(),
            "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "th": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )


def windows(docs: DataFrame) -> DataFrame:
    """(nul, id, th, pos, h1, h2): one row for each three-line window."""
    lines = _keyed(docs.select("doc_id", F.col("text").cast("string").alias("text"))).withColumn("lines", F.split("text", "\n", -1))
    text = "array_join(slice(lines, i + 1, 3), '\n')"
    each = lines.where(F.size("lines") >= WINDOW).select(
        *_ROW, F.posexplode(F.expr(f"transform(sequence(0, size(lines) - {WINDOW}), i -> {text})")).alias("pos", "w")
    )
    return each.where("trim(w) rlike '[^\\\\s]'").select(*_ROW, "pos", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"))


def covered_positions(docs: DataFrame) -> DataFrame:
    """(nul, id, th, covered array<int>): the merged positions that later occurrences cover."""
    found = materialise(windows(docs).dropDuplicates([*_ROW, "pos"]))
    at = F.struct(*_ROW, "pos")
    repeated = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(at).alias("first")).where("n > 1").drop("n")
    later = found.join(repeated, ["h1", "h2"]).where(at != F.col("first"))
    starts = later.groupBy(*_ROW).agg(F.collect_set("pos").alias("starts"))
    return starts.select(*_ROW, F.expr("array_sort(array_distinct(flatten(transform(starts, s -> array(s, s + 1, s + 2)))))").alias("covered"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs with ``text`` rewritten, plus n_lines and n_removed (and n_chars kept true)."""
    own = docs.columns
    keyed = _keyed(docs.select(*[F.col(c).alias(f"c_{c}") for c in own], "doc_id", F.col("text").cast("string").alias("text")))
    marked = keyed.join(covered_positions(docs).withColumnsRenamed({c: f"k_{c}" for c in _ROW}), [F.col(c) == F.col(f"k_{c}") for c in _ROW], "left")
    lines = F.split("text", "\n", -1)
    new = marked.withColumn("lines", lines).withColumn(
        "new",
        F.when(F.col("covered").isNull(), F.col("text")).otherwise(F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), covered), i -> lines[i]), '\n')")),
    )
    fresh = {"text": F.col("new")} | ({"n_chars": F.when(F.col("covered").isNull(), F.col("c_n_chars")).otherwise(F.length("new")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in own else {})
    return new.select(
        *[fresh.get(c, F.col(f"c_{c}")).alias(c) for c in own if c not in ("n_lines", "n_removed")],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its remaining lines."""
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), w AS (
  SELECT doc_id, i - 1 AS pos, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS w
  FROM lines, unnest(range(1, len(l) - 1)) AS t(i) WHERE len(l) >= 3
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS r
  FROM w WHERE regexp_matches(w, '[^\s]')
), covered AS (
  SELECT DISTINCT doc_id, pos + d AS pos FROM ranked, (VALUES (0), (1), (2)) AS t(d) WHERE r > 1
), each_line AS (
  SELECT doc_id, i - 1 AS pos, l[i] AS line FROM lines, unnest(range(1, len(l) + 1)) AS t(i)
), marked AS (
  SELECT e.doc_id, e.pos, e.line, c.pos IS NOT NULL AS gone
  FROM each_line e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.pos = e.pos
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_removed
FROM marked GROUP BY doc_id
"""
