"""Vector codes by product quantisation, with Lloyd rounds that look at active entries only. All sums are integers.

A codebook entry is active in a round if the last update moved it. A part whose own entry stayed is as near to that entry
as before, and no nearer to the others that stayed: it compares the moved entries with the exact distance it keeps. Every
other part compares all entries. Ties go to the lower index in both cases, so the codes are those of a full scan.

Each round reads and writes one table of rows: the vector, its codes and the distances. The codebooks, a fixed number of
entries, are what the driver and the tasks share; the sums that move them are added up by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.common import cut
from coffer.llm.vectors import embeddings, matrix, whole_vectors

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Rows whose distances to all entries of a codebook are held at once.
ROWS = 2048

STATE = "vec_id long, label {label}, x array<long>, codes binary, distances binary"


def _nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry to each row; the lowest index of equals."""
    codes, distances = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for at in range(0, len(x), ROWS):
        squares = np.zeros((len(x[at:at + ROWS]), len(entries)), np.int64)
        for j in range(x.shape[1]):
            squares += (x[at:at + ROWS, j, None] - entries[None, :, j]) ** 2
        best = squares.argmin(1)
        codes[at:at + ROWS], distances[at:at + ROWS] = best, squares[np.arange(len(best)), best]
    return codes, distances


def reassign(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, codes: np.ndarray, distances: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """New codes and distances of one part position, from those of the entries before ``moved`` of them moved."""
    codes, distances = codes.copy(), distances.copy()
    scan = moved[codes]
    active = np.flatnonzero(moved)
    if len(active) and not scan.all():
        stayed = np.flatnonzero(~scan)
        best, squares = _nearest(x[stayed], entries[active])
        best = active[best]
        closer = (squares < distances[stayed]) | ((squares == distances[stayed]) & (best < codes[stayed]))
        codes[stayed[closer]], distances[stayed[closer]] = best[closer], squares[closer]
    if scan.any():
        codes[scan], distances[scan] = _nearest(x[scan], entries)
    return codes, distances


def _assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    """The rows with codes and distances for ``books`` (part, entry, position); rows without codes are scanned."""
    parts, _, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), parts * width).reshape(-1, parts, width)
            first = batch.column("codes").null_count > 0
            if not first:
                old = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
                far = np.frombuffer(b"".join(batch.column("distances").to_pylist()), np.int64).reshape(-1, parts)
            codes, distances = np.empty(x.shape[:2], np.int64), np.empty(x.shape[:2], np.int64)
            for p in range(parts):
                codes[:, p], distances[:, p] = (
                    _nearest(x[:, p], books[p]) if first else reassign(x[:, p], books[p], moved[p], old[:, p], far[:, p])
                )
            found = [[r.tobytes() for r in codes.astype(np.uint8)], [r.tobytes() for r in distances]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(c, pa.binary()) for c in found]], names=batch.schema.names
            )

    return rows.mapInArrow(work, STATE.format(label=rows.schema["label"].dataType.simpleString()))


def _moved_to(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry at the floor of its parts' mean; a task sends a row per entry and component."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), parts * width).reshape(-1, parts, width)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        place = np.flatnonzero(np.repeat(counts.ravel() > 0, width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(sums.ravel()[place]), pa.array(np.repeat(counts.ravel(), width)[place])],
            names=["place", "total", "n"],
        )

    summed = rows.select("x", "codes").mapInArrow(work, "place long, total long, n long")
    summed = summed.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    new = books.ravel().copy()
    for row in summed.collect():  # at most one row per component of the codebooks
        new[row["place"]] = row["total"] // row["n"]
    return new.reshape(books.shape)


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes and errors of the whole vectors, and the codebooks (part, entry, position).

    The rows have vec_id, label, ``codes`` (a byte per part) and ``error`` (squared distances summed over the parts).
    Rows with null, empty or broken vectors are left out. Codebooks start as the rows of the smallest ids; unknown ids come
    last and equal ids in the order of their vectors; with fewer rows than ``entries`` the codebooks are that small. Equal
    rows may all be entries: the lowest is used, the others stay. Rows that repeat an id are coded each by itself. An
    empty table gives no rows and empty codebooks. Vectors of different lengths, or of one that ``parts`` does not divide,
    raise, as do components too large for exact sums. Clashing column names are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte")
    whole = whole_vectors(rows)
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "x").select("x").limit(entries).collect()
    if not first:
        empty = whole.select("vec_id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    if len(first[0].x) % parts:
        raise ValueError(f"{len(first[0].x)} components cannot be cut into {parts} parts")
    start = matrix(pa.array([r.x for r in first], pa.list_(pa.int64())), len(first[0].x))
    books = np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2))
    state = whole.select("*", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("binary").alias("distances"))
    moved = np.ones(books.shape[:2], bool)
    for _ in range(rounds):
        state = cut(_assigned(state, books, moved))
        new = _moved_to(state, books)
        books, moved = new, (new != books).any(2)
    return _summed(_assigned(state, books, moved)), books


def _summed(state: DataFrame) -> DataFrame:
    """vec_id, label, codes and the sum of the distances; kept, so that it is read twice and computed once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = np.frombuffer(b"".join(batch.column("distances").to_pylist()), np.int64).reshape(len(batch), -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("codes"), pa.array(far.sum(1))],
                names=["vec_id", "label", "codes", "error"],
            )

    label = state.schema["label"].dataType.simpleString()
    return cut(state.mapInArrow(work, f"vec_id long, label {label}, codes binary, error long"))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op12_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all whole vectors in hexadecimal, their errors, the errors of their labels, and the codebooks' digest."""
    coded, books = compress(embeddings(spark, sf_dir))
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    steps = [f"""
        whole AS (
            SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        cells AS (
            SELECT vec_id, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS v
            FROM whole, range({parts}) AS r(part)),
        book0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v
            FROM cells WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {entries}))"""]
    for k in range(rounds + 1):
        steps.append(f"""
        far{k} AS (
            SELECT vec_id, part, entry, list_sum(list_transform(list_zip(c.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM cells c JOIN book{k} b USING (part)),
        near{k} AS (SELECT vec_id, part, min((d, entry)) AS best FROM far{k} GROUP BY vec_id, part)""")
        if k < rounds:
            steps.append(f"""
        sums{k} AS (
            SELECT part, entry, pos, sum(c)::BIGINT AS s, count(*) AS n FROM (
                SELECT part, best[2] AS entry, unnest(v) AS c, generate_subscripts(v, 1) AS pos
                FROM near{k} JOIN cells USING (vec_id, part)) GROUP BY part, entry, pos),
        means{k} AS (
            SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM sums{k} GROUP BY part, entry),
        book{k + 1} AS (
            SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN means{k} m USING (part, entry))""")
    return "WITH " + ",".join(steps) + f""",
        coded AS (
            SELECT vec_id, string_agg(lower(printf('%02x', best[2])), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
            FROM near{rounds} GROUP BY vec_id),
        digest AS (
            SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN whole USING (vec_id), digest
    """


SQL = {"op12_code_compression": _sql()}
