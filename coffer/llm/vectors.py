"""What the operators on embeddings share: the rows that count, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 256
#: Scaled components are exact in all sums and squares below this; no embedding comes near it.
LARGEST = 1 << 24


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label and ``x``, the components as floor(256 c), of the rows whose vector is whole.

    A vector that is null or empty, or holds null, NaN or infinity, is left out. Rows that repeat an id are rows of their
    own; null ids and labels stay null. Other columns are not read, whatever their names.
    """
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE)).alias("x"),
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as one array of integers; raises where a row is not ``width`` long or is too large."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * width or (np.diff(column.offsets.to_numpy()) != width).any():
        raise ValueError(f"all vectors must have {width} components")
    if len(flat) and max(flat.max(), -flat.min()) > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // SCALE} cannot be summed exactly")
    return flat.reshape(len(column), width)
