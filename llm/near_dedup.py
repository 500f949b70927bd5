"""MinHash near-duplicate detection on bottom-k sketches from one hash function.

1. Every text becomes its set of distinct five-word shingle hashes; the ``k`` smallest hashes
   are its sketch.  Equal sets form one class, so exact copies cost one row each.
2. Retained values that occur in two classes or more are inverted lists.  A class enters the
   lists of its first ``m`` values that are not common (at most ``common`` classes); when more
   than half of its sketch is common, it enters lists of common values as well.
3. Inside a block of a list the union sketch (the ``k`` smallest of both) estimates the similarity;
   pairs under the threshold by five standard deviations are dropped.
4. Surviving pairs form coarse groups; their texts are read again, and the exact Jaccard
   similarity of the full sets confirms links in blocks bounded in rows and shingles.
5. Components of the confirmed links give each document its smallest reachable doc_id.

A list or a group of more than a block is dealt into chunks and compared in two rounds.  First every
chunk is compared with itself and with chunk 0, which is twice the group's rows.  Then only members that
are not yet in the group's largest component meet the other chunks.  As nothing but connections is wanted,
no pair inside a component is looked at again, and a large group of copies of one text costs its rows, not their square.

Defined results: a text that is null, empty or without words has n_shingles 0 and is linked with
nothing; one to four words are a single shingle; repeated rows and rows that share a doc_id are
compared like any others and keep their own row; a null doc_id gives a null component_id, and the
row is kept; an empty table gives an empty table; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import Forest, runs
from llm.components import components
from llm.session import discard, materialise, spread, unused
from llm.textkernel import SHINGLE, shingle_sets

SKETCH = 48
LISTS = 12
COMMON = 256
BLOCK_ROWS = 512
BLOCK_SHINGLES = 2_000_000
#: Blocks of up to so many rows are estimated together, all pairs at once.
WHOLE_BLOCK = 48
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _node(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch_rows(k: int, size: int):
    """mapInArrow function: (doc_id, th, text) -> (doc_id, th, n_shingles, node, sketch)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low, counts, nodes = [], [], []
            for s in shingle_sets(b.column("text"), size):  # one full set at a time
                low.append(s[:k].view(np.int64).copy())
                counts.append(len(s))
                nodes.append(_node(s) if len(s) else None)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in low])]).astype(np.int32)
            flat = np.concatenate(low) if low else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").cast(pa.int64()),
                    b.column("th"),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["doc_id", "th", "n_shingles", "node", "sketch"],
            )

    return run


def union_estimates(sketches: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of row pairs from the smallest k values of each pair's union (padded with the top value)."""
    k = sketches.shape[1]
    out = np.empty(len(a))
    for at in range(0, len(a), 8192):
        x = np.sort(np.concatenate([sketches[a[at : at + 8192]], sketches[b[at : at + 8192]]], axis=1), axis=1)
        same = np.zeros(x.shape, dtype=bool)
        same[:, 1:] = x[:, 1:] == x[:, :-1]
        real = x != _NONE
        rank = np.cumsum(real & ~same, axis=1)
        used = np.minimum(rank[:, -1], k)
        out[at : at + 8192] = (same & real & (rank <= k)).sum(axis=1) / np.maximum(used, 1)
    return out


def _padded(sketches: list[np.ndarray], k: int) -> np.ndarray:
    out = np.full((len(sketches), k), _NONE)
    for i, s in enumerate(sketches):
        out[i, : min(k, len(s))] = s[:k]
    return out


def cutoff(percent: int, k: int) -> float:
    t = percent / 100
    return t - 5 * sqrt(t * (1 - t) / k)


def block_links(sketches: np.ndarray, upto: np.ndarray, least: float, part: np.ndarray, label: np.ndarray, inside: bool, quiet: np.ndarray, confirm=None) -> list[tuple[int, int]]:
    """Links that join the rows of one block, a spanning forest of them; rows are sorted by set size.

    Row i is compared with rows up to upto[i] that do not share its label yet: those of its own part (if
    ``inside``), then those of the other part.  Links between two quiet rows only join, as another block
    returns them.
    """
    label, out = np.unique(label, return_inverse=True)[1], []
    for same in ([True] if inside else []) + ([False] if len(part) and (part != part[0]).any() else []):
        for i in range(len(sketches)):
            near = np.arange(i + 1, upto[i])
            near = near[(label[near] != label[i]) & ((part[near] == part[i]) == same)]
            if not len(near):
                continue
            for j in near[union_estimates(sketches, np.full(len(near), i), near) >= least].tolist():
                if label[i] != label[j] and (confirm is None or confirm(i, j)):
                    label[label == label[j]] = label[i]
                    if not (quiet[i] and quiet[j]):
                        out.append((i, j))
    return out


def _pairs(node: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(node[ends[:, 0]]), pa.array(node[ends[:, 1]])], names=["a", "b"])


def coarse_links(percent: int, k: int, inside: bool):
    """mapInArrow function over (g, b1, b2, part, quiet, label, node, n_shingles, sketch) sorted by block -> (a, b)."""
    least = cutoff(percent, k)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        held = pairs = 0

        def flush() -> pa.RecordBatch:
            node = np.concatenate(nodes)
            a, b = np.concatenate(left), np.concatenate(right)
            keep = union_estimates(np.concatenate(rows), a, b) >= least
            _, at = np.unique(node, return_inverse=True)
            forest, out = Forest(len(node)), []
            for i, j in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
                if forest.join(int(at[i]), int(at[j])):
                    out.append((i, j))
            return _pairs(node, out)

        for t in runs(batches, ["g", "b1", "b2"]):
            m = t.num_rows
            if m < 2:
                continue
            n = t.column("n_shingles").to_numpy()
            order = np.argsort(n, kind="stable")
            n = n[order]
            # partners of row i: rows after it whose set is no larger than n[i] * 100 / percent
            upto = np.searchsorted(n * percent, n * 100, side="right")
            spans = np.maximum(upto - np.arange(m) - 1, 0)
            total = int(spans.sum())
            if not total:
                continue
            a = np.repeat(np.arange(m), spans)
            b = a + 1 + np.arange(total) - np.repeat(np.cumsum(spans) - spans, spans)
            sketch = t.column("sketch").combine_chunks()
            sketch = sketch.combine_chunks() if isinstance(sketch, pa.ChunkedArray) else sketch
            ends, flat = np.asarray(sketch.offsets), np.asarray(sketch.values).view(np.uint64)
            low, node = _padded([flat[ends[i] : ends[i + 1]] for i in order], k), t.column("node").to_numpy()[order]
            part, quiet, label = (t.column(c).to_numpy()[order] for c in ("part", "quiet", "label"))
            if m > WHOLE_BLOCK or not inside or quiet.any():
                yield _pairs(node, block_links(low, upto, least, part, label, inside, quiet))
                continue
            rows.append(low)
            nodes.append(node)
            left.append(a + held)
            right.append(b + held)
            held += m
            pairs += total
            if pairs >= 16384:
                yield flush()
                nodes, rows, left, right, held, pairs = [], [], [], [], 0, 0
        if pairs:
            yield flush()

    return run


def exact_links(percent: int, k: int, size: int, inside: bool):
    """mapInArrow function over (g, b1, b2, part, quiet, label, node, text) sorted by block -> confirmed (a, b)."""
    least = cutoff(percent, k)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["g", "b1", "b2"]):
            if t.num_rows < 2:
                continue
            sets = [s for chunk in t.column("text").chunks for s in shingle_sets(chunk, size)]
            order = np.argsort([len(s) for s in sets], kind="stable")
            sets = [sets[i] for i in order]
            n = np.array([len(s) for s in sets], dtype=np.int64)

            def same(i: int, j: int, sets=sets) -> bool:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                return 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)

            upto = np.searchsorted(n * percent, n * 100, side="right")
            node, part, quiet, label = (t.column(c).to_numpy()[order] for c in ("node", "part", "quiet", "label"))
            yield _pairs(node, block_links(_padded(sets, k), upto, least, part, label, inside, quiet, same))

    return run


def _compared(blocks: DataFrame, payload: DataFrame, links) -> DataFrame:
    """The links of blocks(g, b1, b2, part, quiet, label, node), each with its node's payload, written."""
    rows = blocks.join(payload.hint("merge"), "node").repartition("g", "b1", "b2").sortWithinPartitions("g", "b1", "b2")
    return materialise(rows.mapInArrow(links, "a long, b long"))


def grouped_links(placed: DataFrame, payload: DataFrame, links) -> DataFrame:
    """placed(g, node, chunks) -> written (node, root): components of the links among the nodes of each group.

    links(inside) makes the mapInArrow function that compares a block.
    """
    dealt = placed.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    own = dealt.withColumn("b1", F.explode(F.when(F.col("chunk") == 0, F.expr("sequence(0, chunks - 1)")).otherwise(F.array("chunk"))))
    here = F.col("chunk") == F.col("b1")
    first = _compared(own.select("g", "b1", F.lit(0).alias("b2"), F.col("chunk").alias("part"), (~here).alias("quiet"), F.col("node").alias("label"), "node"), payload, links(True))
    joined = components(first)
    large = dealt.where("chunks > 2")  # chunk 0 has met all others
    if large.isEmpty():
        discard(first)
        return joined
    marked = materialise(large.join(joined, "node", "left").select("g", "node", "chunks", "chunk", F.coalesce("root", "node").alias("label")))
    sizes = marked.groupBy("g", "label").agg(F.count("*").alias("n"), F.first("chunks").alias("chunks"))
    most = sizes.groupBy("g").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"), F.first("chunks").alias("chunks"))
    split = F.ceil((F.col("all") - F.col("most.n")) * F.col("chunks") / F.col("all")).cast("int")
    open_ = materialise(most.where(F.col("all") > F.col("most.n")).select("g", F.col("most.label").alias("most"), split.alias("others")))
    if open_.isEmpty():
        discard(first, marked, open_)
        return joined
    rows = marked.join(spread(open_, "g"), "g")
    place = lambda b1, b2, part: [F.col("g"), b1.cast("int").alias("b1"), b2.cast("int").alias("b2"), F.lit(part).alias("part"), F.lit(False).alias("quiet"), F.col("label"), F.col("node")]
    met = rows.withColumn("b2", F.explode(F.expr("sequence(0, others - 1)"))).select(*place(F.col("chunk"), F.col("b2"), 0))
    left = rows.where(F.col("label") != F.col("most")).withColumn("b1", F.explode(F.expr("sequence(0, chunks - 1)")))
    second = _compared(met.unionByName(left.select(*place(F.col("b1"), F.pmod(F.xxhash64(F.lit(1), "node"), F.col("others")), 1))), payload, links(False))
    out = joined
    if not second.isEmpty():
        out = components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).union(second))
        discard(joined)
    discard(first, marked, open_, second)
    return out


def _identified(docs: DataFrame) -> list:
    """doc_id and a hash of the text, which tell rows apart."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th")]


def duplicate_classes(docs: DataFrame, percent: int = 80, k: int = SKETCH, m: int = LISTS, common: int = COMMON, size: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs(doc_id, text) -> written (doc_id, th, n_shingles, node, ..) of every row, (node, own, ..) of every class, (node, root) of linked ones.

    ``own`` is a class's first row by (doc_id is null, doc_id, text hash).

    Rows are linked when 100 * |intersection| >= percent * |union| of their shingle sets.
    """
    slim = docs.select(*_identified(docs), F.col("text").cast("string").alias("text"))
    rows = materialise(slim.mapInArrow(sketch_rows(k, size), "doc_id long, th long, n_shingles long, node long, sketch array<long>"))
    own = F.min(F.struct(F.col("doc_id").isNull().alias("nul"), F.coalesce("doc_id", F.lit(0)).alias("id"), "th")).alias("own")
    classes = materialise(rows.where("node is not null").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), own))
    values = classes.select("node", F.size("sketch").alias("kept"), F.posexplode("sketch").alias("pos", "v"))
    shared = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    picks = (
        values.join(spread(shared, "v"), "v")
        .groupBy("node")
        .agg(
            F.first("kept").alias("kept"),
            F.count_if(F.col("df") > common).alias("n_common"),
            F.array_sort(F.collect_list(F.when(F.col("df") <= common, F.struct("pos", "v", "df")))).alias("rare"),
            F.array_sort(F.collect_list(F.when(F.col("df") > common, F.struct("pos", "v", "df")))).alias("often"),
        )
        .withColumn("often", F.when(F.col("n_common") * 2 > F.col("kept"), F.slice("often", 1, m)).otherwise(F.slice("often", 1, 0)))
        .select("node", F.explode(F.concat(F.slice("rare", 1, m), "often")).alias("p"))
    )
    # no list is longer than the number of classes that hold its value
    chunks = lambda x: F.greatest(F.lit(1), F.ceil(x)).cast("int").alias("chunks")
    placed = materialise(picks.select(F.col("p.v").alias("g"), "node", chunks(F.col("p.df") / BLOCK_ROWS)))
    coarse = grouped_links(placed, classes.select("node", "n_shingles", "sketch"), lambda inside: coarse_links(percent, k, inside))
    groups = materialise(coarse.join(classes.select("node", "n_shingles", "own"), "node"))
    discard(coarse, placed)
    sizes = groups.groupBy("root").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("total"))
    placed = materialise(groups.join(spread(sizes, "root"), "root").select(F.col("root").alias("g"), "node", chunks(F.greatest(F.col("members") / BLOCK_ROWS, F.col("total") / BLOCK_SHINGLES))))
    # one text of each class in a group: that of its first row
    named = slim.where("text is not null").select(F.col("doc_id").isNull().alias("nul"), F.coalesce("doc_id", F.lit(0)).alias("id"), "th", "text")
    texts = materialise(groups.select("node", "own.*").join(named.hint("merge"), ["nul", "id", "th"]).groupBy("node").agg(F.first("text").alias("text")))
    found = grouped_links(placed, texts, lambda inside: exact_links(percent, k, size, inside))
    discard(groups, placed, texts)
    return rows, classes, found


def near_duplicates(docs: DataFrame, percent: int = 80, **options) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_shingles, component_id, kept), one row per input row; options as in duplicate_classes."""
    rows, classes, linked = duplicate_classes(docs, percent, **options)
    own = classes.select("node", F.when(~F.col("own.nul"), F.col("own.id")).alias("class_id"))
    ids = linked.join(own, "node")
    names = ids.groupBy("root").agg(F.min("class_id").alias("component_id"))
    labels = ids.join(spread(names, "root"), "root").select("node", "component_id")
    named = materialise(own.join(labels, "node", "left").select("node", F.coalesce("component_id", "class_id").alias("component_id")))
    discard(classes, linked)
    # both sides are plain tables, so a class of very many copies can be split between tasks
    found = rows.join(named, "node", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates, the first by (doc_id, text hash), null ids last; rows without words stay.

    Rows are told apart by doc_id and text, so clean rows that share a doc_id with a copy stay, and of rows
    equal in both one stays.  The columns are those of docs, whatever their names.
    """
    rows, classes, linked = duplicate_classes(docs, percent)
    key = ["nul", "id", "th"]
    each = rows.where("node is not null").select("node", F.col("doc_id").isNull().alias("nul"), F.coalesce("doc_id", F.lit(0)).alias("id"), "th").groupBy("node", *key).agg(F.count("*").alias("n"))
    placed = materialise(each.join(linked, "node", "left").select(*key, "n", F.coalesce("root", "node").alias("root")))
    first = placed.groupBy("root").agg(F.min(F.struct(*key)).alias("first"))
    judged = placed.join(spread(first, "root"), "root").select(*key, "n", (F.struct(*key) == F.col("first")).alias("stays"))
    odd = materialise(judged.where("not stays or n > 1"))  # rows that go, and rows that stay once
    discard(placed, classes, linked, rows)
    names = unused(docs, *key)
    doc_id, th = _identified(docs)
    keyed = docs.withColumns(dict(zip(names, [F.col("doc_id").isNull(), F.coalesce(doc_id, F.lit(0)), th], strict=True)))
    of = lambda rows: rows.select(*[F.col(k).alias(n) for k, n in zip(key, names, strict=True)])
    out = keyed.join(of(odd), names, "left_anti")
    repeated = odd.where("stays")
    if not repeated.isEmpty():
        out = out.unionByName(keyed.join(of(repeated), names, "left_semi").dropDuplicates(names))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its component at a similarity of 0.85."""
    from llm.session import table

    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


#: Exact sets and links, and components by walking them.
OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(l) >= 5 THEN list_distinct(list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')))
                      WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END AS s FROM words
), shingles AS (
  SELECT doc_id, unnest(s) AS s FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE 100 * c >= 85 * (len(p.s) + len(q.s) - c)
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
), least AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON x = doc_id
"""
