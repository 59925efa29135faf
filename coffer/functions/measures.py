"""Aggregate shorthands."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_when(condition: Column, value: Column | str) -> Column:
    """Sum of the rows that satisfy the condition; 0 where there are none."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("decimal(18,2)"))


def total(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(value), F.lit(0).cast("decimal(18,2)"))


def volume_value_by(column: str, values: Iterable[str], amount: str = "amount", stem: str = "") -> list[Column]:
    """One count and one sum per value of a code column, then the totals.

    Columns: ``<value>_volume``, ``<value>_value``, ``total_volume``, ``total_value``, in lower case.
    """
    out: list[Column] = []
    for v in values:
        hit = F.col(column) == v
        out.append(count_when(hit).alias(f"{v.lower()}{stem}_volume"))
        out.append(sum_when(hit, amount).alias(f"{v.lower()}{stem}_value"))
    out.append(F.count(F.lit(1)).alias("total_volume"))
    out.append(total(amount).alias("total_value"))
    return out


def count_by(column: str, values: dict[str, str]) -> list[Column]:
    """One count per code, named by the mapping code -> column name."""
    return [count_when(F.col(column) == code).alias(name) for code, name in values.items()]


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, halves away from zero. Reckoned in whole cents, so no half is lost to binary fractions."""
    cents = lambda c: (c.cast("decimal(28,2)") * 100).cast("decimal(30,0)")
    p, w = cents(part), cents(whole)
    hundredths = F.call_function("div", F.abs(p) * 20000 + w, w * 2)
    return F.signum(p) * hundredths / 100
