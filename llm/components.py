"""Connected components of an edge table by alternating large-star and small-star rounds.

A round is a partial aggregate (the smallest neighbour) and a join on the node.  Both sides of the join
are plain shuffles of narrow rows, so adaptive execution can split the rows of a hub between tasks; no
part of the graph reaches the driver.  A round's table is removed once the next one is written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import Forest
from llm.session import discard, materialise, spread


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """edges(a, b) without loops; each node hangs its neighbours on its smallest one."""
    ends = F.array(F.struct("a", "b")) if small else F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.select(F.explode(ends).alias("e")).select("e.*")
    least = spread(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "a")
    hung = both.join(least, "a")
    if small:
        out = hung.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
    else:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether edges(a, b) are stars: each a has one b, and no b is an a."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("child")), F.struct(F.col("b").alias("n"), F.lit(0).alias("child")))).alias("e"))
    return ends.groupBy("e.n").agg(F.sum("e.child").alias("up"), F.min("e.child").alias("root")).where("up > 1 or up = 1 and root = 0").isEmpty()


def _contracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's edges as stars, which saves rounds and repeated edges."""
    for batch in batches:
        ends = np.stack([batch.column("a").to_numpy(), batch.column("b").to_numpy()])
        nodes, at = np.unique(ends, return_inverse=True)
        forest = Forest(len(nodes))
        for i, j in at.reshape(2, -1).T.tolist():
            forest.join(i, j)
        roots = forest.roots()
        leaves = np.flatnonzero(roots != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[leaves]), pa.array(nodes[roots[leaves]])], names=["a", "b"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges(a long, b long) -> (node long, root long), written: the smallest node that each node reaches.

    Loops and nulls are ignored; only nodes that have an edge appear (a root among them).
    """
    now = edges.where("a is not null and b is not null and a <> b").select("a", "b").mapInArrow(_contracted, "a long, b long")
    for _ in range(max_rounds):
        new = materialise(_star(_star(now, small=False), small=True))
        discard(now)
        now = new
        if _settled(now):
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = materialise(now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
    discard(now)
    return out
