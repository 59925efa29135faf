"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.llm.common import cut

#: Links that one task joins by itself; more go through rounds of stars until so few are left.
BLOCK_LINKS = 50_000


def least_of(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, ascending, and the smallest node of each one's component."""
    nodes, at = np.unique(np.r_[src, dst], return_inverse=True)
    one, other = at[:len(src)], at[len(src):]
    least = np.arange(len(nodes))
    while True:
        a, b = least[one], least[other]
        apart = a != b
        if not apart.any():
            return nodes, nodes[least]
        np.minimum.at(least, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (least[least] != least).any():
            least = least[least]


def _in_a_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if held:
        found = least_of(*(np.concatenate(c) for c in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["node", "component"])


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Tie each node's neighbours (only the smaller, or only the larger ones) to the smallest node around it."""
    if larger_only:
        around = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    else:
        around = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = around.groupBy("src").agg(F.min("dst").alias("least"))
    joined = around.join(least, "src").withColumn("least", F.least("src", "least"))
    moved = joined.where("dst > src" if larger_only else "dst <> least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    if not larger_only:
        moved = moved.unionByName(least.select("src", F.col("least").alias("dst")))
    return moved.where("src <> dst").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node that has a link; ``component`` is its smallest node.

    ``edges`` has the columns src and dst. Each round is written to the checkpoint folder; the number of rounds grows with the
    logarithm of the longest path. A hub's rows are combined before they are shuffled, and joins on it may be split. Links
    that are or become no more than ``BLOCK_LINKS`` are joined in one block, which saves the rounds.
    """
    edges = cut(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            )
        if now[0] <= BLOCK_LINKS:
            return edges.coalesce(1).mapInArrow(_in_a_block, "node long, component long")
        state = now
        edges = cut(_star(_star(edges, True), False))
