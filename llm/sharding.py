"""K-d tree sharding: recursive splits at distributed weighted medians, with DataFrame functions only.

Each document is a point of metadata dimensions scaled to 0..2**30-1 (size on a logarithmic scale,
position of doc_id, source, language) and weighs its bytes.  A node is split along its widest
dimension - the one whose weighted standard deviation is largest - at the point where the weights to
its left come to its left child's share of the leaves.  The split key is the dimension followed by 32 hashed bits of
the row, so a dimension value shared by a third of all rows is split like any other.  The median is
found by histogram refinement: sums of weight by key prefix, pre-aggregated on the map side, then the
one bucket that holds the median is refined; the driver sees one row per node and round.

All nodes of a level are worked on together, so the number of jobs follows the depth of the tree.

Defined results: a null text weighs 1 byte and has the checksum of an empty text; null metadata takes
the lowest place of its dimension; repeated rows are points of their own; an empty table gives an empty table; other
columns play no part.  Leaf sizes differ by the resolution of the last histogram bucket plus a row.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.session import materialise, table

SHARDS = 16
DIM_BITS = 30
TIE_BITS = 32
BUCKET_BITS = 16
#: A split may miss its share of a node's weight by this fraction before the next refinement.
TOLERANCE = 1e-5
SLOT_ROWS = 50_000
_DIMS = ("d_size", "d_id", "d_source", "d_lang")


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, uid, tie and the scaled dimensions; written once, read by every round."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has = set(docs.columns)
    place = lambda c: F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))), 64 - DIM_BITS) if c in has else F.lit(0).cast("long")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place("source").alias("d_source"),
        place("lang").alias("d_lang"),
        F.monotonically_increasing_id().alias("uid"),
    )
    base = materialise(base)
    ends = base.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max("size").alias("top")).first()
    lo, wide = float(ends.lo or 0), max(1.0, float((ends.hi or 0) - (ends.lo or 0)))
    cap = 2**DIM_BITS - 1
    scaled = lambda x: F.greatest(F.lit(0), F.least(F.lit(cap), F.floor(x * cap))).cast("long")
    return base.select(
        "doc_id", "size", "text_crc32", "uid", "d_source", "d_lang",
        scaled(F.log2(F.col("size").cast("double")) / F.log2(F.lit(float(max(2, ends.top or 2))))).alias("d_size"),
        F.coalesce(scaled((F.col("doc_id").cast("double") - lo) / wide), F.lit(0)).alias("d_id"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "uid"), 64 - TIE_BITS).alias("tie"),
    )


def _widest(rows: DataFrame) -> DataFrame:
    """(node, weight, dim): each node's weight and the number of its widest dimension."""
    w = F.col("size").cast("double")
    scale = float(2**DIM_BITS)
    sums = [F.sum("size").alias("weight"), F.count("*").alias("n")]
    for d in _DIMS:
        x = F.col(d) / scale
        sums += [F.sum(w * x).alias(f"{d}_1"), F.sum(w * x * x).alias(f"{d}_2")]
    got = rows.groupBy("node").agg(*sums)
    var = lambda d: F.col(f"{d}_2") / F.col("weight") - F.pow(F.col(f"{d}_1") / F.col("weight"), 2)
    order = F.array(*[F.struct(F.round(var(d), 9).alias("v"), F.lit(-i).alias("d")) for i, d in enumerate(_DIMS)])
    return got.select("node", "weight", (-F.array_max(order)["d"]).cast("int").alias("dim"))


def _values(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A literal table; at most one row for each node of the tree."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(str, r)) + ')' for r in rows)} AS t({', '.join(names.split())})")


def _cut_level(spark: SparkSession, rows: DataFrame, shares: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """For each node that splits, (dimension, first key of its right child); shares: leaves (left, all)."""
    info = {r.node: r for r in _widest(rows).collect() if r.node in shares}
    bits = DIM_BITS + TIE_BITS
    #: node -> [dim, key prefix so far, bits fixed, weight wanted to the left of the cut within the prefix]
    state = {n: [r.dim, 0, 0, r.weight * shares[n][0] / shares[n][1]] for n, r in info.items()}
    cuts: dict[int, tuple[int, int]] = {}
    while state:
        small = _values(spark, "node dim prefix fixed wanted", [(n, s[0], f"{s[1]}L", s[2], f"{float(s[3])!r}D") for n, s in state.items()])
        dim = F.element_at(F.array(*_DIMS), F.col("dim") + 1)
        key = F.shiftleft(dim, TIE_BITS).bitwiseOR(F.col("tie"))
        inside = rows.join(F.broadcast(small), "node").withColumn("key", key).where(F.expr(f"shiftright(key, {bits} - fixed) = prefix"))
        sums = inside.groupBy("node", F.expr(f"shiftright(key, {bits} - fixed - least({BUCKET_BITS}, {bits} - fixed))").alias("bucket")).agg(F.sum("size").alias("w"))
        running = "sum(w) over (partition by node order by bucket)"
        crossing = (
            sums.join(F.broadcast(small.select("node", "wanted")), "node")
            .withColumn("upto", F.expr(running))
            .where("upto >= wanted")
            .groupBy("node")
            .agg(F.min(F.struct("bucket", "w", "upto")).alias("c"))
            .select("node", "c.*")
        )
        found = {r.node: r for r in crossing.collect()}
        nxt = {}
        for n, (d, prefix, fixed, want) in state.items():
            r = found.get(n)
            if r is None:  # no weight inside: cut at the prefix's end
                cuts[n] = (d, (prefix + 1) << (bits - fixed))
                continue
            fixed += min(BUCKET_BITS, bits - fixed)
            before = r.upto - r.w
            if fixed == bits or r.w <= TOLERANCE * info[n].weight:
                after = r.bucket + (1 if r.upto - want <= want - before else 0)
                cuts[n] = (d, after << (bits - fixed))
            else:
                nxt[n] = [d, r.bucket, fixed, want - before]
        state = nxt
    return cuts


def kd_leaves(docs: DataFrame, n_leaves: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """points() with ``shard``: 0..n-1, where n is given or follows from the bytes that a leaf should hold."""
    spark = docs.sparkSession
    rows = points(docs)
    if n_leaves is None:
        total = rows.agg(F.sum("size").alias("s")).first().s or 0
        n_leaves = max(1, ceil(total / target_bytes))
    rows = materialise(rows.withColumn("node", F.lit(0)))
    #: node -> (first leaf, number of leaves)
    nodes = {0: (0, n_leaves)}
    while any(n > 1 for _, n in nodes.values()):
        shares = {k: (n // 2, n) for k, (_, n) in nodes.items() if n > 1}
        cuts = _cut_level(spark, rows, shares)
        turned, moves = {}, []
        for k, (first, n) in nodes.items():
            if n > 1 and k in cuts:
                turned |= {2 * k + 1: (first, n // 2), 2 * k + 2: (first + n // 2, n - n // 2)}
                moves.append((k, *cuts[k]))
            elif n == 1:
                turned[k] = (first, 1)
        if not moves:
            break
        small = _values(spark, "node dim cut", [(k, d, f"{c}L") for k, d, c in moves])
        dim = F.element_at(F.array(*_DIMS), F.col("dim") + 1)
        key = F.shiftleft(dim, TIE_BITS).bitwiseOR(F.col("tie"))
        child = F.when(F.col("cut").isNull(), F.col("node")).otherwise(F.col("node") * 2 + F.when(key < F.col("cut"), 1).otherwise(2))
        rows = rows.join(F.broadcast(small), "node", "left").withColumn("node", child.cast("int")).drop("dim", "cut")
        nodes = turned
    leaf = _values(spark, "node shard", [(k, first) for k, (first, _) in nodes.items()])
    return rows.join(F.broadcast(leaf), "node").drop("node")


def with_slots(rows: DataFrame) -> DataFrame:
    """``slot``: gapless from 0 within each shard; no task holds more than a bucket of a shard."""
    n = rows.count()
    spread = rows.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(max(1, ceil(n / SLOT_ROWS)))))
    counts = spread.groupBy("shard", "bucket").agg(F.count("*").alias("here"))
    offsets = counts.select("shard", "bucket", F.expr("sum(here) over (partition by shard order by bucket) - here").alias("offset"))
    inside = F.expr("row_number() over (partition by shard, bucket order by uid) - 1")
    return spread.withColumn("inside", inside).join(offsets, ["shard", "bucket"]).withColumn("slot", (F.col("offset") + F.col("inside")).cast("long"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` in one of 16 shards of nearly equal bytes."""
    placed = materialise(kd_leaves(table(spark, sf_dir, "documents"), n_leaves=SHARDS))
    return with_slots(placed).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
