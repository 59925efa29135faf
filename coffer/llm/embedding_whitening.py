"""Whitening directions of integer-scaled embeddings, by blockwise QR and a bidiagonal quotient-difference solver.

The fit list is the distinct vectors. Their sums, in integers, give the centre; tasks reduce centred blocks of rows to
triangles by QR, and groups of triangles are stacked and reduced again until one is left, so what leaves a task is one
triangle of the size of the dimensions. Its singular values and right vectors (``bidiagonal``) are those of all centred
rows: squared and divided by the number of rows they are the eigenvalues and eigenvectors of the covariance, which is
never formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.bidiagonal import leading
from coffer.llm.common import cut
from coffer.llm.vectors import embeddings, matrix, whole_vectors

COMPONENTS = 4
#: Triangles stacked in one task.
FAN_IN = 16
#: Rows of a block that is reduced at once, beside the triangle so far.
ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """What a fit found: rows of the list, their sums, the total variance, eigenvalues and their vectors as columns."""

    n: int
    sums: np.ndarray
    trace: float
    eigenvalues: np.ndarray
    directions: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S per row, exact: integers of any size where 64 bits do not hold them."""
        most = int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0))
        return self.n * (x if most < 2**63 else x.astype(object)) - self.sums

    def whiten(self, x: np.ndarray) -> np.ndarray:
        centred = self.centred(x).astype(float) / self.n
        return centred @ (self.directions / np.sqrt(self.eigenvalues))


def _sums(fit: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Rows and the sum of each dimension; a task sends one row per dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), width)
            n, total = n + len(x), total + x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total), pa.array(np.full(width, n))], names=["at", "total", "n"])

    found = fit.mapInArrow(work, "at long, total long, n long").groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    rows = sorted(found.collect())  # one row per dimension
    return rows[0]["n"], np.array([r["total"] for r in rows], np.int64)


def _reduced(triangle: np.ndarray, rows: np.ndarray) -> np.ndarray:
    width = rows.shape[1]
    r = np.linalg.qr(np.vstack([triangle, rows]), mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def triangle(fit: DataFrame, centre: Whitening, width: int) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            centred = centre.centred(matrix(batch.column("x"), width)).astype(float) / centre.n
            for at in range(0, len(centred), ROWS):
                r = _reduced(r, centred[at:at + ROWS])
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()])], names=["r"])

    def stacked(table: pa.Table) -> pa.Table:
        r = np.zeros((0, width))
        for part in table.column("r").to_pylist():
            r = _reduced(r, np.frombuffer(part).reshape(width, width))
        return pa.table({"r": [r.tobytes()]})

    triangles = cut(fit.mapInArrow(block, "r binary").withColumn("part", F.spark_partition_id()))
    parts = triangles.rdd.getNumPartitions()
    while parts > 1:
        groups = -(-parts // FAN_IN)
        grouped = triangles.select((F.col("part") % groups).alias("part"), "r").groupBy("part")
        merged = grouped.applyInArrow(lambda key, table: stacked(table).append_column("part", pa.array([key[0].as_py()], pa.int32())), "r binary, part int")
        triangles = cut(merged)
        parts = groups
    return np.frombuffer(triangles.first()["r"]).reshape(width, width)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Each distinct ``x`` of ``whole_vectors`` once."""
    return rows.select("x").distinct()


def learn(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the fit list, ``distinct_vectors`` that are kept somewhere; None for an empty one.

    Components whose variance is zero to double precision are left out: a single vector, or copies of one, has none.
    """
    first = fit.first()
    if first is None:
        return None
    width = len(first["x"])
    n, sums = _sums(fit, width)
    centre = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((width, 0)))
    r = triangle(fit, centre, width)
    squares, vectors = leading(r, components)
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0) < 0, -1.0, 1.0)
    return Whitening(n, sums, float((r**2).sum() / n), squares / n, vectors)


def whitened(rows: DataFrame, found: Whitening) -> DataFrame:
    """vec_id, deviation and ``whitened`` (an array with a value per component) of every row of ``whole_vectors``.

    ``deviation`` is the sum over dimensions of (n x - S) squared, exact; null where it does not fit a long.
    """
    width = len(found.sums)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width)
            centred = found.centred(x)
            most = int(np.abs(centred).max(initial=0))
            squares = (centred if width * most**2 < 2**63 else centred.astype(object)) ** 2
            deviation = [d if d < 2**63 else None for d in squares.sum(1).tolist()]
            values = found.whiten(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(deviation, pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel())),
            ], names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(work, "vec_id long, deviation long, whitened array<double>")


def identity_error(fit: DataFrame, found: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened distinct vectors, centred first, minus the identity."""
    k = len(found.eigenvalues)
    values = whitened(fit.withColumn("vec_id", F.lit(None).cast("long")), found).select(
        *[F.get("whitened", F.lit(i)).alias(f"w{i}") for i in range(k)]
    )
    means = values.agg(*[F.avg(f"w{i}").alias(f"w{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = values.agg(*[F.sum((F.col(f"w{i}") - means[i]) * (F.col(f"w{j}") - means[j])) for i, j in pairs]).first()
    return max((abs(s / found.n - (i == j)) for s, (i, j) in zip(sums, pairs, strict=True)), default=0.0)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per whole vector and leading component: its whitened coordinate, and the fit's figures.

    Rows whose vector is null, empty or not finite are left out; rows that repeat a vector count once in the fit and come
    out alike; null ids stay null. Fewer components come out where the distinct vectors span fewer dimensions: none for a
    single one, and then no rows. Vectors of different lengths raise. Only vec_id and embedding are read.
    """
    rows = whole_vectors(embeddings(spark, sf_dir))
    fit = cut(distinct_vectors(rows))
    found = learn(fit)
    if found is None or not len(found.eigenvalues):
        return spark.createDataFrame([], RESULT)
    error = identity_error(fit, found)
    explained = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues])
    coordinates = whitened(rows, found).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return coordinates.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
