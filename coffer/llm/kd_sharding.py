"""Sharding by a k-d tree over document metadata, with leaves of equal bytes. DataFrame functions only.

A node that stands for ``k`` shards is split where the lower part weighs ``k // 2`` shards' share of its bytes, along the
metadata dimension in which its rows spread widest. All nodes of a level are split together. The weighted median comes
from three histograms of 4,096 bins per node (coordinate, then two parts of a tie hash), so what a level sends to the
driver is one row per node, and a coordinate that a third of the rows share is split like any other. The finished tree
is one CASE expression; no row is joined to it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coffer.llm.common import cut, documents, text_of

SHARDS = 40
#: Bits of a histogram, and so of a coordinate; the tie hash has twice as many.
BITS = 12
BINS = 1 << BITS
#: Bytes a row weighs beside its text.
ROW_BYTES = 16
#: Rows of a shard numbered by one task.
SLOT_ROWS = 100_000

DIMENSIONS = ("by_source", "by_lang", "by_length", "by_id")


def _hashed(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(BINS)).cast("int")


def metadata(docs: DataFrame) -> DataFrame:
    """One narrow row per document: id, size, CRC, four coordinates of ``BITS`` bits and a tie hash.

    Coordinates: hashed source, hashed language, logarithm of the size, and the place of the id in the id range. A
    missing source, lang or id has a coordinate like any other value; absent columns count as null.
    """
    for name, kind in (("source", "string"), ("lang", "string")):
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
        (F.octet_length(text_of()) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = int(low or 0), int(high or 0)
    place = (F.col("doc_id").cast("double") - float(low)) / float(max(1, high - low)) * (BINS - 1)
    return rows.select(
        "doc_id", "size", "text_crc32",
        _hashed("source").alias("by_source"), _hashed("lang").alias("by_lang"),
        F.least(F.lit(BINS - 1), F.floor(F.log2("size") * (BINS / 48))).cast("int").alias("by_length"),
        F.coalesce(F.least(F.lit(BINS - 1), F.floor(place)), F.lit(0)).cast("int").alias("by_id"),
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(BINS * BINS)).alias("tie"),
    )


def _branch(tree: dict, leaf) -> Column:
    """The value ``leaf(node)`` of the leaf that a row belongs to."""
    if "split" not in tree:
        return F.lit(leaf(tree))
    dimension, limit = tree["split"]
    key = F.col(dimension).cast("long") * (BINS * BINS) + F.col("tie")
    return F.when(key < limit, _branch(tree["low"], leaf)).otherwise(_branch(tree["high"], leaf))


def _leaves(tree: dict) -> list[dict]:
    return [tree] if "split" not in tree else _leaves(tree["low"]) + _leaves(tree["high"])


def _crossing(rows: DataFrame, bins: Column, targets: dict[int, float]) -> dict[int, tuple[int, int, int]]:
    """For each node: the bin in which its running weight passes the target, the weight before it and the bin's own."""
    target = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    running = F.sum("weight").over(
        Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        rows.groupBy("node", bins.alias("bin")).agg(F.sum("size").alias("weight"))
        .withColumn("upto", running)
        .where(F.col("upto") > target[F.col("node")])
        .groupBy("node").agg(F.min(F.struct("bin", (F.col("upto") - F.col("weight")).alias("before"), "weight")).alias("x"))
    )
    return {r["node"]: (r["x"]["bin"], r["x"]["before"], r["x"]["weight"]) for r in found.collect()}


def _split_level(rows: DataFrame, tree: dict) -> bool:
    """Split every leaf that stands for more than one shard; false if there is none left to split."""
    open_leaves = {leaf["first"]: leaf for leaf in _leaves(tree) if leaf["shards"] > 1 and not leaf.get("bare")}
    if not open_leaves:
        return False
    placed = rows.withColumn("node", _branch(tree, lambda n: n["first"])).where(F.col("node").isin(list(open_leaves)))
    spread = placed.groupBy("node").agg(
        F.sum("size").alias("weight"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
    ).collect()
    for first in set(open_leaves) - {r["node"] for r in spread}:
        open_leaves.pop(first)["bare"] = True
    widest = {r["node"]: max(DIMENSIONS, key=lambda d: r[d]) for r in spread}
    goal = {r["node"]: r["weight"] * (open_leaves[r["node"]]["shards"] // 2) / open_leaves[r["node"]]["shards"] for r in spread}
    if not goal:
        return False
    dimension = F.create_map(*[F.lit(x) for n, d in widest.items() for x in (n, DIMENSIONS.index(d))])[F.col("node")]
    coordinate = F.array(*DIMENSIONS)[dimension]
    digits = (coordinate.cast("long"), F.shiftright("tie", BITS), F.col("tie") % BINS)
    prefix, left, part = dict.fromkeys(goal, 0), dict(goal), placed
    for depth, digit in enumerate(digits):
        found = _crossing(part, digit, left)
        for node, (at, before, weight) in found.items():
            prefix[node] = prefix[node] * BINS + at
            left[node] -= before
            if depth == 2 and left[node] > weight / 2:
                prefix[node] += 1
        if depth < 2:
            at = F.create_map(*[F.lit(x) for n, (b, _, _) in found.items() for x in (n, b)])[F.col("node")]
            part = part.where(digit == at)
    for node, leaf in open_leaves.items():
        half = leaf["shards"] // 2
        leaf["split"] = (widest[node], prefix[node])
        leaf["low"] = {"first": leaf["first"], "shards": half}
        leaf["high"] = {"first": leaf["first"] + half, "shards": leaf["shards"] - half}
    return True


def build_tree(rows: DataFrame, shards: int) -> dict:
    """The tree over ``metadata`` rows; its leaves are the shards 0 to ``shards - 1``."""
    tree = {"first": 0, "shards": shards}
    while _split_level(rows, tree):
        pass
    return tree


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """Number of shards whose leaves reach, and do not pass by more than a row, ``target_bytes``."""
    return max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) / target_bytes))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    Leaf sizes differ from equal shares by less than the rows at a cut, as long as rows differ: rows that repeat id and
    text have the same tie hash and stay together. Null texts weigh ``ROW_BYTES``. Slots count from 0 without gaps in
    the order of (a hash group of) ids; rows with equal ids are numbered in any order. An empty table gives no rows.
    """
    rows = cut(metadata(docs))
    tree = build_tree(rows, shards)
    parts = max(1, math.ceil(rows.count() / (shards * SLOT_ROWS)))
    placed = rows.select(
        "doc_id", "size", "text_crc32", _branch(tree, lambda n: n["first"]).alias("shard"),
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"),
    )
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32"))
    return placed.withColumn("number", number).join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("number") - 1).alias("slot")
    )


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
