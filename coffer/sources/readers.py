"""Readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table, checked against a schema where one is given."""
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


def read_csv_list(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A reference list kept as CSV with a header line."""
    return spark.read.csv(path, header=True, schema=schema)


def jdbc_options(
    url: str, table_or_query: str, user: str, password: str, driver: str | None = None, fetch_size: int = 10_000,
    partition_column: str | None = None, lower: int | None = None, upper: int | None = None, partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read.

    With a partition column the read is split into ``partitions`` id ranges that executors pull in parallel; the
    bounds only place the splits, rows outside them are read too. A query then goes in as a derived table, because the
    ``query`` option cannot be split.
    """
    is_query = " " in table_or_query.strip()
    options = {"url": url, "user": user, "password": password, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if partition_column is None:
        options["query" if is_query else "dbtable"] = table_or_query
        return options
    if lower is None or upper is None or partitions is None:
        raise ValueError("a split read needs lower, upper and partitions")
    options["dbtable"] = f"({table_or_query}) src" if is_query else table_or_query
    options.update(
        partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
    )
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


class SchemaMismatch(ValueError):
    """A table lacks a declared column or has it with another type."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Selects the declared columns in order, after a check of names and types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    faults = []
    for want in schema.fields:
        if want.name not in have:
            faults.append(f"{want.name}: missing")
        elif have[want.name] != want.dataType:
            faults.append(f"{want.name}: {have[want.name].simpleString()} instead of {want.dataType.simpleString()}")
    if faults:
        raise SchemaMismatch("; ".join(faults))
    return df.select(*[f.name for f in schema.fields])
