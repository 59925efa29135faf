"""Joins on keys that are often unknown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_known(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``; rows without a key never meet, so they are not shuffled to the one task of the null key."""
    known = left.filter(F.col(key).isNotNull()).join(right, key, "left")
    unknown = left.filter(F.col(key).isNull())
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    return known.unionByName(unknown.select("*", *added))


def referrers(clients: DataFrame, name: str) -> DataFrame:
    """The clients that referred somebody, as ``referred_by_id`` and their name."""
    who = clients.filter(F.col("referred_by_id").isNotNull()).select(F.col("referred_by_id").alias("client_id")).distinct()
    return clients.join(who, "client_id", "left_semi").select(
        F.col("client_id").alias("referred_by_id"), F.col("client_name").alias(name)
    )


def of_listed_keys(large: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows of a large table whose key a list names; the list may be beyond the broadcast limit.

    Where the scan of ``large`` is above ``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold``, Spark
    builds a Bloom filter of the list and drops most rows at the scan, before they are shuffled to the join. It does so only
    for a list that a filter made of a scan, so the list is not made distinct first, which a semi join does not need.
    """
    return large.join(listed.select(key).filter(F.col(key).isNotNull()), key, "left_semi")
