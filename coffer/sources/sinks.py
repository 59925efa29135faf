"""Writers. Each is one distributed write; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.sources.incremental import duplicate_keys, one_row_per_key

def overwrite_snapshot(df: DataFrame, path: str) -> None:
    """Full reload: the new rows replace the table."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).saveAsTable(name)


def write_per_party(df: DataFrame, path: str, party: str | Sequence[str], max_rows_per_file: int = 5_000_000) -> None:
    """One folder per party in one job.

    Rows are rebalanced by party before the write, so a small party is one file. Adaptive execution splits a party with
    a large share of the rows over several tasks, and the row limit bounds the files.
    """
    parties = [party] if isinstance(party, str) else list(party)
    (
        df.hint("rebalance", *parties)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(*parties)
        .parquet(path)
    )


def write_by_year(df: DataFrame, path: str, year: str = "year") -> None:
    """Yearly tables as one table with a folder per year, so a year filter prunes the rest."""
    df.write.mode("append").partitionBy(year).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def repair_in_place(
    spark: SparkSession, path: str, by: Sequence[str], keys: Sequence[str], order: Sequence[Column]
) -> list[tuple]:
    """Drops repeats of a key inside a folder of a partitioned table, and writes only folders that hold some.

    ``by`` are the folders' columns; of rows with equal ``by`` and ``keys`` the first in ``order`` stays. Counting reads the key
    columns alone. The folders with repeats, whose names come to the driver as any commit's do, are read whole, and
    dynamic overwrite swaps just these: all others keep their files. Returns the folders written.
    """
    table = spark.read.parquet(path)
    repeated = duplicate_keys(table, [*by, *keys]).select(*by).distinct().collect()
    if repeated:
        # the folders as one IN filter on the first column, which prunes at planning, and the exact tuples after it
        folders = spark.createDataFrame(repeated, table.select(*by).schema)
        hit = table.filter(F.col(by[0]).isin([r[0] for r in repeated])).join(folders, list(by), "left_semi")
        kept = one_row_per_key(hit, [*by, *keys], order).select(*table.columns)
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return [tuple(r) for r in repeated]
