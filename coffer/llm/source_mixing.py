"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks of about ``block_bytes``. Target weights are whole slots out of a period of ``PERIOD``. Block
j of a source with p slots is released at slot floor(j * PERIOD / p) and due before slot ceil((j + 1) * PERIOD / p); the
earliest deadline among the released blocks takes the next slot. As the slots add up to the period, no deadline is
missed, and after any number of slots a source has within one block of its share. The schedule repeats after a period.

Sources with less than a ``UNITS``-th of all weight share slots: they are dealt into groups of about ``GROUP``, a group is
scheduled like one source of their joint weight, and its turns are dealt to its members by the same rule, each group in a
task of its own. So the driver holds at most 2 * ``UNITS`` weights and one period however many sources there are, and many
small sources do not crowd out the targets of the large ones. Blocks find their slots by joins, each by itself.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coffer.llm.common import cut, documents, text_of

PERIOD = 16_384
BLOCK_BYTES = 262_144
#: Bytes a row weighs beside its text.
ROW_BYTES = 16
#: Target weight of a source: its share of bytes to this power, in proportion. Below 1 small sources gain.
TEMPERATURE = 0.95
#: Rows of a source that one task puts in order.
PART_ROWS = 20_000
#: A source with less than this part of all weight shares slots with others; there are at most as many groups of them.
UNITS = 1024
#: Sources of a group, about, and slots of its period per member.
GROUP, TURNS = 256, 16
#: Stands for a null source while rows are grouped.
NO_SOURCE = "\x00"
#: Stands behind every slot.
NO_SLOT = (1 << 63) - 1


def slots_per_period(weights: dict, period: int = PERIOD) -> dict:
    """Whole slots per source, which add up to the period: one each below a slot's weight, else by largest remainders."""
    weights = {k: w for k, w in weights.items() if w > 0}
    slots, rest, total = {}, max(period, len(weights)), math.fsum(weights.values())
    for k in sorted(weights, key=lambda k: (weights[k], str(k))):
        if weights[k] * rest >= total:
            break
        slots[k], rest, total = 1, rest - 1, total - weights[k]
    exact = {k: w * rest / total for k, w in weights.items() if k not in slots}
    slots |= {k: math.floor(x) for k, x in exact.items()}
    rest -= sum(math.floor(x) for x in exact.values())
    for k in sorted(exact, key=lambda k: (math.floor(exact[k]) - exact[k], str(k)))[:rest]:
        slots[k] += 1
    return slots


def schedule(slots: dict) -> list[tuple]:
    """One period: (source, block within the period, slot), earliest deadline first among released blocks."""
    period, out = sum(slots.values()), []
    waiting = [(0, str(k), k, 0) for k in slots]  # by release
    heapq.heapify(waiting)
    ready: list[tuple] = []  # by deadline
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, name, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // slots[k]), name, k, j))
        _, name, k, j = heapq.heappop(ready)
        out.append((k, j, slot))
        if j + 1 < slots[k]:
            heapq.heappush(waiting, ((j + 1) * period // slots[k], name, k, j + 1))
    return out


def _running(value: str, *order: str) -> Column:
    window = Window.partitionBy("source", "part").orderBy(*order)
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, source, size and block of every row; a block number counts a source's bytes in the order of hashed ids.

    A source of any size is ordered by many tasks: ids are dealt into parts by hash, and a part starts where the
    parts before it end.
    """
    rows = cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE)).alias("source"),
        (F.octet_length(text_of()) + ROW_BYTES).cast("long").alias("size"), F.xxhash64(text_of()).alias("tag"),
    ))
    parts = max(32, math.ceil(rows.count() / PART_ROWS))
    rows = rows.withColumn("order", F.xxhash64("doc_id")).withColumn("part", F.pmod("order", F.lit(parts)).cast("int"))
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"))
    ends = rows.withColumn("end", _running("size", "order", "doc_id", "size", "tag")).join(starts, ["source", "part"])
    first = F.col("start") + F.col("end") - F.col("size")
    return ends.select("doc_id", "source", "size", "tag", F.floor(first / block_bytes).cast("long").alias("block"))


def weighed(placed: DataFrame, weights: dict | None, power: float) -> DataFrame:
    """source, weight, blocks of the source, and the unit that is scheduled: the source, or a group of small ones."""
    sums = placed.groupBy("source").agg(F.sum("size").alias("bytes"), (F.max("block") + 1).alias("blocks"))
    if weights is None:
        found = sums.withColumn("weight", F.pow("bytes", F.lit(power)))
    else:
        named = [(NO_SOURCE if k is None else k, float(w)) for k, w in weights.items()]
        named = placed.sparkSession.createDataFrame(_table(named, source=pa.string(), weight=pa.float64()))
        found = sums.join(named, "source")
    found = cut(found.where("weight > 0").select("source", "weight", "blocks"))
    total = found.agg(F.sum("weight")).first()[0] or 0.0
    small = F.col("weight") * UNITS < total
    groups = min(UNITS, math.ceil(found.where(small).count() / GROUP))
    group = F.pmod(F.xxhash64("source"), F.lit(max(1, groups)))
    return found.withColumn("unit", F.when(small, F.concat(F.lit("t"), group)).otherwise(F.concat(F.lit("s"), "source")))


def _turns(members: pd.DataFrame) -> pd.DataFrame:
    """One period of a unit: which of its turns are whose."""
    slots = slots_per_period(
        dict(zip(members["source"], members["weight"], strict=True)), TURNS * len(members) if len(members) > 1 else 1
    )
    total = sum(slots.values())
    rows = [(k, members["unit"].iloc[0], slots[k], total, j, at) for k, j, at in schedule(slots)]
    return pd.DataFrame(rows, columns=["source", "unit", "own_turns", "unit_turns", "part_turn", "turn_in_unit"])


def _table(rows: list[tuple], **types: pa.DataType) -> pa.Table:
    """The rows with columns of these names and types."""
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(types.items(), columns, strict=True)})


def block_slots(spark: SparkSession, placed: DataFrame, found: DataFrame, period: int) -> DataFrame:
    """source, block and slot of every block, and of the first block behind the last of each source (``missing``)."""
    weights = {r["unit"]: r["weight"] for r in found.groupBy("unit").agg(F.sum("weight").alias("weight")).collect()}
    slots = slots_per_period(weights, period)
    total = sum(slots.values())
    # as Arrow tables, which no Python worker has to read
    plan = spark.createDataFrame(_table(schedule(slots), unit=pa.string(), turn=pa.int64(), slot_in_period=pa.int64()))
    per_unit = spark.createDataFrame(_table(list(slots.items()), unit=pa.string(), per_period=pa.int64()))
    turns = cut(found.groupBy("unit").applyInPandas(
        _turns, "source string, unit string, own_turns long, unit_turns long, part_turn long, turn_in_unit long"
    ))
    sources = turns.where("part_turn = 0").select("source", "own_turns")
    every = placed.select("source", "block", F.lit(False).alias("missing")).distinct().unionByName(
        found.select("source", F.col("blocks").alias("block"), F.lit(True).alias("missing"))
    )
    turned = every.join(sources, "source").withColumn("part_turn", F.col("block") % F.col("own_turns"))
    turned = turned.join(turns.drop("own_turns"), ["source", "part_turn"])
    in_unit = F.floor(F.col("block") / F.col("own_turns")) * F.col("unit_turns") + F.col("turn_in_unit")
    # both tables have at most a period of rows
    timed = turned.withColumn("unit_turn", in_unit).join(F.broadcast(per_unit), "unit")
    timed = timed.withColumn("turn", F.col("unit_turn") % F.col("per_period")).join(
        F.broadcast(plan), ["unit", "turn"]
    )
    slot = F.floor(F.col("unit_turn") / F.col("per_period")) * total + F.col("slot_in_period")
    return timed.select("source", "block", "missing", slot.cast("long").alias("slot"))


def mix(docs: DataFrame, weights: dict | None = None, block_bytes: int = BLOCK_BYTES, power: float = TEMPERATURE,
        period: int = PERIOD) -> DataFrame:
    """doc_id, source, tag (hash of the text), block, slot and in_mix of every row.

    ``weights`` names target weights by source; without it they follow the sources' bytes to ``power``. Rows of sources
    without a weight have no slot. A source ends with its last block; its later slots stay empty, so the others go on in
    proportion to their own weights. ``in_mix`` marks the rows before the first empty slot: up to there the weights of
    all sources hold, behind it those of the sources that are left. A null source is a source of
    its own, named None in ``weights``. Null texts weigh ``ROW_BYTES``. Rows that repeat an id stand next to each
    other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    placed = cut(blocks(docs, block_bytes))
    timed = cut(block_slots(spark, placed, weighed(placed, weights, power), period))
    horizon = timed.where("missing").agg(F.min("slot")).first()[0] or 0
    slots = timed.where(~F.col("missing")).select("source", "block", "slot")
    return placed.join(slots, ["source", "block"], "left").select(
        "doc_id", F.when(F.col("source") != NO_SOURCE, F.col("source")).alias("source"), "tag", "block", "slot",
        F.coalesce(F.col("slot") < horizon, F.lit(False)).alias("in_mix"),
    )


def slots_of(docs: DataFrame, **options) -> DataFrame:
    """doc_id, tag and slot, once each; rows that repeat id and text have the first of their slots."""
    return mix(docs, **options).groupBy("doc_id", "tag").agg(F.min("slot").alias("slot"))


def in_order(docs: DataFrame, **options) -> DataFrame:
    """All rows of ``docs`` in the order of their slots; those without one come last."""
    keys = slots_of(docs, **options).select(
        F.col("doc_id").alias("_key_id"), F.col("tag").alias("_key_tag"), F.coalesce("slot", F.lit(NO_SLOT)).alias("_key_slot")
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_key_id")) & (F.xxhash64(text_of()) == F.col("_key_tag"))
    order = ["_key_slot", "_key_id", "_key_tag"]
    return docs.join(keys, same).orderBy(*order).drop(*order)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mix of the sources."""
    return mix(documents(spark, sf_dir)).drop("tag")
