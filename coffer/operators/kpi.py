"""KPI marts: one rule for periods, one declaration per mart."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.dates import DateLike, before_month_of, month_text, year_to_date

GRAINS = ("monthly", "ytd")


def period_kpi(
    df: DataFrame, ts: str, grain: str, measures: Sequence[Column], as_of: DateLike, keys: Sequence[str] = ()
) -> DataFrame:
    """Measures by period and keys.

    ``monthly``: all months before the month of ``as_of``. ``ytd``: the days of the year of ``as_of`` up to it. The
    filter is a plain comparison of ``ts`` with a constant, so it reaches the scan.
    """
    if grain == "monthly":
        return (
            df.filter(before_month_of(F.col(ts), as_of))
            .groupBy(F.trunc(ts, "month").alias("_month"), *keys)
            .agg(*measures)
            .select(month_text(F.col("_month")).alias("month"), "*")
            .drop("_month")
        )
    if grain == "ytd":
        return (
            df.filter(year_to_date(F.col(ts), as_of))
            .groupBy(F.to_date(ts).alias("date"), *keys)
            .agg(*measures)
        )
    raise ValueError(f"unknown grain {grain!r}")


def top_by_period(df: DataFrame, ts: str, grain: str, item: str, as_of: DateLike, count_name: str) -> DataFrame:
    """Most frequent item of each period, all of them where they tie.

    The rank filter becomes a group limit before the shuffle: each task keeps only its own leaders per period.
    """
    counts = period_kpi(df, ts, grain, [F.count(F.lit(1)).alias(count_name)], as_of, [item])
    period = counts.columns[0]
    best = Window.partitionBy(period).orderBy(F.col(count_name).desc())
    return counts.withColumn("_rank", F.rank().over(best)).filter(F.col("_rank") == 1).drop("_rank")


def quota_by_period(
    df: DataFrame, ts: str, grain: str, party: str, quota: int, as_of: DateLike
) -> DataFrame:
    """Totals of transfers within and above a free quota per party and period."""
    per_party = period_kpi(df, ts, grain, [F.count(F.lit(1)).alias("transfers")], as_of, [party])
    period = per_party.columns[0]
    return per_party.groupBy(period).agg(
        F.sum("transfers").alias("total_transfers"),
        F.sum(F.least("transfers", F.lit(quota))).alias("free_transfers"),
        F.sum(F.greatest(F.col("transfers") - quota, F.lit(0))).alias("additional_transfers"),
    )


def customers_and_mean(party: str) -> list[Column]:
    """Distinct parties and whole transactions per party."""
    return [
        F.countDistinct(party).alias("total_customers"),
        F.expr(f"count(1) div count(distinct {party})").alias("avg_transactions_per_customer"),
    ]


@dataclass(frozen=True)
class Mart:
    """Declaration of a mart: source rows, time column, measures and extra keys."""

    source: Callable[[object], DataFrame]
    ts: str
    measures: Callable[[], Sequence[Column]]
    as_of: DateLike
    keys: Sequence[str] = field(default_factory=tuple)
    grains: Sequence[str] = GRAINS

    def build(self, tables: object, grain: str) -> DataFrame:
        return period_kpi(self.source(tables), self.ts, grain, self.measures(), self.as_of, self.keys)


def mart_names(marts: Mapping[str, Mart]) -> list[tuple[str, str, str]]:
    """(query name, mart, grain) of every mart and grain."""
    return [(f"mart_{name}_{grain}", name, grain) for name, mart in marts.items() for grain in mart.grains]
