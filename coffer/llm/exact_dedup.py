"""Exact dedup against a minimal perfect hash over historical distinct digests.

History is reduced to one winner per distinct digest, dealt into buckets by digest, and each bucket becomes one row of an
index: a minimal perfect hash whose slots hold the full digest and the locator of the winner. An arriving digest goes to
its bucket, is hashed to the only slot it could have, and counts as known only if all 32 bytes in the slot agree.
Digests that are not in the index form groups of their own.

The hash is a cascade of bit arrays: a key that is alone at its place in a level is settled there, the others go to the
next level; the rank of a key's bit is its slot.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.common import cut, documents, text_of

#: Expected digests of an index bucket, which is built and probed in one task.
BUCKET_DIGESTS = 512
#: Bits of a level per key that enters it.
LOAD = 1.5
#: Levels before the remaining keys are kept as a list; reached only by keys that share 128 bits.
MAX_LEVELS = 48

INDEX_SCHEMA = (
    "bucket long, n_slots long, level_bits array<long>, bits binary, digests binary, winner_ids binary,"
    " winner_null binary, winner_points binary, copies binary"
)


def normalised(column: str = "text") -> Column:
    """Text without ASCII white space; null counts as empty."""
    return F.regexp_replace(text_of(column), r"[\x20\x09-\x0D]+", "")


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One narrow row per document: id, SHA-256 of the normalised text, code points of the original text."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.unhex(F.sha2(normalised(text_column), 256)).alias("digest"),
        F.char_length(text_of(text_column)).cast("long").alias("points"),
    )


def best() -> Column:
    """Winner of a group: most code points, then a known id, then the smallest id."""
    return F.max(F.struct("points", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("order")))


def distinct_digests(rows: DataFrame, *extra: str) -> DataFrame:
    """One row per digest (and ``extra`` columns) with its winner and number of copies; combines before the shuffle."""
    grouped = rows.groupBy("digest", *extra).agg(best().alias("w"), F.count("*").alias("copies"))
    return grouped.select(
        "digest", *extra, F.bitwise_not("w.order").alias("doc_id"), F.col("w.points").alias("points"), "copies"
    )


def bucket_of(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).alias("bucket")


def _arriving(groups: DataFrame, n_buckets: int) -> DataFrame:
    """Groups as a bucket's task takes them; a missing id is a flag, since pandas would make all ids fractions."""
    return groups.select(
        bucket_of(n_buckets), "digest", F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"), "points", "copies",
    )


def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)
    return words[:, 1], words[:, 2]


def _place(first: np.ndarray, second: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (first + np.uint64(level) * second) ^ (second >> np.uint64(level % 61))
    return (mixed % np.uint64(bits)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, all bits, and the order of the rows by slot."""
    first, second = _words(digests)
    left = np.arange(len(digests))
    sizes, parts, order = [], [], []
    while len(left) and len(sizes) < MAX_LEVELS:
        size = max(1, math.ceil(LOAD * len(left)))
        place = _place(first[left], second[left], len(sizes), size)
        taken = np.bincount(place, minlength=size)
        alone = taken[place] == 1
        parts.append(taken == 1)
        order.append(left[alone][np.argsort(place[alone])])
        sizes.append(size)
        left = left[~alone]
    order.append(left)
    return sizes, np.concatenate(parts) if parts else np.zeros(0, bool), np.concatenate(order)


def slots_of(digests: np.ndarray, sizes: list[int], bits: np.ndarray, n_slots: int) -> np.ndarray:
    """The slot each digest would have if it were in the index; -1 where no level holds it."""
    first, second = _words(digests)
    slot = np.full(len(digests), -1, dtype=np.int64)
    rank = np.concatenate([[0], np.cumsum(bits)])
    start, left = 0, np.arange(len(digests))
    for level, size in enumerate(sizes):
        at = start + _place(first[left], second[left], level, size)
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    return slot


def _build_bucket(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("digest", key=lambda s: s.map(bytes))
    digests = np.frombuffer(b"".join(pdf["digest"]), dtype=np.uint8).reshape(-1, 32)
    sizes, bits, order = build_hash(digests)
    pdf = pdf.iloc[order]
    return pd.DataFrame({
        "bucket": [key[0]], "n_slots": [len(pdf)], "level_bits": [sizes], "bits": [np.packbits(bits).tobytes()],
        "digests": [digests[order].tobytes()],
        "winner_ids": [pdf["doc_id"].to_numpy("<i8").tobytes()],
        "winner_null": [pdf["no_id"].to_numpy(np.uint8).tobytes()],
        "winner_points": [pdf["points"].to_numpy("<i8").tobytes()],
        "copies": [pdf["copies"].to_numpy("<i8").tobytes()],
    })


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """The index of ``distinct_digests`` rows: one row per bucket, ``INDEX_SCHEMA``; may be written and kept."""
    return _arriving(history, n_buckets).groupBy("bucket").applyInPandas(_build_bucket, INDEX_SCHEMA)


GROUP_SCHEMA = "digest binary, keep_id long, group_size long, known boolean, slot long"


def _probe_bucket(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    """All groups of a bucket: the index's slots, brought up to date with the batch, and the groups of non-members."""
    if len(index):
        row = index.iloc[0]
        n = int(row["n_slots"])
        held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        ids = np.frombuffer(row["winner_ids"], "<i8").copy()
        no_id = np.frombuffer(row["winner_null"], np.uint8).astype(bool)
        points = np.frombuffer(row["winner_points"], "<i8").copy()
        copies = np.frombuffer(row["copies"], "<i8").copy()
        sizes = [int(x) for x in row["level_bits"]]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
    else:
        n, held, sizes, bits = 0, np.zeros((0, 32), np.uint8), [], np.zeros(0, bool)
        ids = points = copies = np.zeros(0, np.int64)
        no_id = np.zeros(0, bool)
    new = np.frombuffer(b"".join(batch["digest"]), np.uint8).reshape(-1, 32)
    slot = slots_of(new, sizes, bits, n) if len(new) else np.zeros(0, np.int64)
    member = slot >= 0
    member[member] = (held[slot[member]] == new[member]).all(axis=1)
    if not member.all() and n > bits.sum():  # keys that no level could settle
        rest = {held[i].tobytes(): i for i in range(int(bits.sum()), n)}
        for i in np.flatnonzero(~member):
            slot[i] = rest.get(new[i].tobytes(), -1)
            member[i] = slot[i] >= 0
    new_null, new_ids = batch["no_id"].to_numpy(bool), batch["doc_id"].to_numpy(np.int64)
    new_points, new_copies = batch["points"].to_numpy(np.int64), batch["copies"].to_numpy(np.int64)
    at, by = slot[member], np.flatnonzero(member)
    better = (new_points[by] > points[at]) | ((new_points[by] == points[at]) & (
        (~new_null[by] & no_id[at]) | (~new_null[by] & ~no_id[at] & (new_ids[by] < ids[at]))))
    ids[at[better]], points[at[better]], no_id[at[better]] = new_ids[by[better]], new_points[by[better]], new_null[by[better]]
    copies[at] += new_copies[by]
    alone = ~member
    keep = pd.array(np.concatenate([ids, new_ids[alone]]), dtype="Int64")
    keep[np.concatenate([no_id, new_null[alone]])] = pd.NA
    return pd.DataFrame({
        "digest": [x.tobytes() for x in held] + [x.tobytes() for x in new[alone]],
        "keep_id": keep, "group_size": np.concatenate([copies, new_copies[alone]]),
        "known": np.concatenate([np.ones(n, bool), np.zeros(int(alone.sum()), bool)]),
        "slot": np.concatenate([np.arange(n), np.full(int(alone.sum()), -1)]),
    })


def probe(index: DataFrame, batch: DataFrame, n_buckets: int) -> DataFrame:
    """Every group of history and batch with its winner over both; ``batch`` holds ``distinct_digests`` rows."""
    return index.groupBy("bucket").cogroup(_arriving(batch, n_buckets).groupBy("bucket")).applyInPandas(_probe_bucket, GROUP_SCHEMA)


def dedup(history: DataFrame, arriving: DataFrame) -> DataFrame:
    """Rows of both tables (``keyed`` form) with the winner of their group.

    Columns: doc_id, keep_id, group_size, kept, text_sha256, known (the digest was in history). Null and empty texts are
    one group like any other. A row with a null id wins only where no equal text as long has an id; ``kept`` is then true
    for the rows without id. Rows that repeat an id and text all carry that id as ``keep_id``. Empty tables give no rows.
    """
    rows = cut(history.withColumn("old", F.lit(True)).unionByName(arriving.withColumn("old", F.lit(False))))
    n_buckets = max(1, math.ceil(rows.count() / BUCKET_DIGESTS))
    groups = distinct_digests(rows, "old")
    index = build_index(groups.where("old"), n_buckets)
    found = probe(index, groups.where("not old"), n_buckets)
    return rows.drop("points", "old").join(found, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "known",
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table deduplicated as it would arrive: the earlier half of the id range is history, the later half a batch."""
    rows = keyed(documents(spark, sf_dir))
    low, high = documents(spark, sf_dir).agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((low or 0) + (high or 0)) // 2
    is_old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return dedup(rows.where(is_old), rows.where(~is_old)).drop("known")


SQL = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents),
        w AS (
            SELECT text_sha256, arg_min(doc_id, (-length(t), doc_id)) AS keep_id, count(*) AS group_size
            FROM d GROUP BY ALL)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM d JOIN w USING (text_sha256)
    """,
}
