"""Running sums over keys of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_WIDTH = 1 << 20


def running_balance(
    movements: DataFrame, key: str, day: str, order_id: str, signed_amount: str, name: str, width: int = SLICE_WIDTH
) -> DataFrame:
    """Running sum of ``signed_amount`` per key, ordered by day and then id.

    One key may own a third of the rows, so no window runs over a whole key's rows. Rows are summed inside slices of
    (key, day, id range); ids are unique, so a slice never holds more than ``width`` rows. What came before a slice is
    added from the table of slice totals, by one window over a key's slices.
    """
    sliced = movements.withColumn("_day", F.to_date(day)).withColumn("_slice", F.floor(F.col(order_id) / width))
    inside = Window.partitionBy(key, "_day", "_slice").orderBy(order_id).rowsBetween(Window.unboundedPreceding, 0)

    slice_totals = sliced.groupBy(key, "_day", "_slice").agg(F.sum(signed_amount).alias("_total"))
    earlier = Window.partitionBy(key).orderBy("_day", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    return (
        sliced.withColumn("_inside", F.sum(signed_amount).over(inside))
        .join(offsets, [key, "_day", "_slice"])
        .withColumn(name, (F.col("_inside") + F.col("_before")).cast("decimal(28,2)"))
        .drop("_day", "_slice", "_inside", "_before")
    )


def running_total_over_day(
    events: DataFrame, day: str, ts: str, order_id: str, amount: str, name: str, width: int = SLICE_WIDTH
) -> DataFrame:
    """Running sum over each day in time order and then by id, where one day may hold a large share of all events.

    Same idea with time as the order: events are summed inside slices of (instant, id range), slices are added up per
    second and seconds per day. Ids are unique, so also when a whole day is booked at one instant no task meets more than
    ``width`` events; the tables of totals hold one row per slice that occurs.
    """
    cut = events.withColumn("_second", F.date_trunc("second", ts)).withColumn("_slice", F.floor(F.col(order_id) / width))
    slices = [day, "_second", ts, "_slice"]
    totals = cut.groupBy(*slices).agg(F.sum(amount).alias("_total"))
    in_second = Window.partitionBy(day, "_second").orderBy(ts, "_slice").rowsBetween(Window.unboundedPreceding, -1)
    in_day = Window.partitionBy(day).orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    seconds = totals.groupBy(day, "_second").agg(F.sum("_total").alias("_total")).select(
        day, "_second", F.coalesce(F.sum("_total").over(in_day), F.lit(0)).alias("_before_second")
    )
    offsets = (
        totals.withColumn("_before_slice", F.coalesce(F.sum("_total").over(in_second), F.lit(0)))
        .join(seconds, [day, "_second"])
        .select(*slices, (F.col("_before_second") + F.col("_before_slice")).alias("_before"))
    )
    inside = Window.partitionBy(*slices).orderBy(order_id).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("_inside", F.sum(amount).over(inside))
        .join(offsets, slices)
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_second", "_slice", "_inside", "_before")
    )
