"""Connected components of an edge table: parts are contracted by themselves, then alternating stars, all distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.common import discard, written

MOST_TURNS = 60
#: Edges that one task contracts, or that stand on one side of a join unwritten.
PART_EDGES = 400_000


def _largest(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # The sums are written before the join, so that the edges of a node with very many can be split in it.
    least, _ = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; edges have u > v."""
    least, _ = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges that are not the smallest of their component, and that smallest node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        one, two = root[a], root[b]
        apart = one != two
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        u, v = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(2))
        u, v = contract(u, v)
        yield pa.record_batch({"u": pa.array(u), "v": pa.array(v)})


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for each node that has an edge (u, v). A written table.

    Edges are first contracted in parts of about `PART_EDGES`, each to stars; one part is then done. Several go on by turns of
    two sums by node with their joins; edges only ever shrink toward stars, and a turn's result is written, so lost executors
    cost one turn. Self-loops and repeated edges do no harm; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    whole, whole_path = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    parts = -(-whole.count() // PART_EDGES)
    now, path = written(whole.repartition(max(parts, 1)).mapInArrow(_contracted, "u long, v long"), "edges")
    discard(spark, whole_path)
    before = None
    for _ in range(MOST_TURNS if parts > 1 else 0):
        new, new_path = written(_smaller(_largest(now)), "edges")
        mark = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(spark, path)
        now, path = new, new_path
        if before == mark:
            break
        before = mark
    else:
        if parts > 1:
            raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
