"""Date predicates and calendars. ``as_of`` stands for "today" everywhere, so results can be reproduced."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DateLike = dt.date | str


def as_date(value: DateLike) -> dt.date:
    """ISO text or a date, as a date."""
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day(value: DateLike, offset: int = 0) -> Column:
    """A date literal, moved by ``offset`` days. Computed on the driver so that the filter reaches the scan."""
    return F.lit(as_date(value) + dt.timedelta(days=offset))


def before_month_of(ts: Column, as_of: DateLike) -> Column:
    """True before the first day of the month of ``as_of``."""
    return ts < F.lit(as_date(as_of).replace(day=1))


def year_to_date(ts: Column, as_of: DateLike) -> Column:
    """True from 1 January of the year of ``as_of`` through ``as_of`` itself."""
    return (ts >= F.lit(as_date(as_of).replace(month=1, day=1))) & (ts < day(as_of, 1))


def last_days(ts: Column, as_of: DateLike, days: int) -> Column:
    """The ``days`` full days that end yesterday."""
    return (ts >= day(as_of, -days)) & (ts < day(as_of))


def on_day(ts: Column, the_day: DateLike) -> Column:
    return (ts >= day(the_day)) & (ts < day(the_day, 1))


def yesterday(ts: Column, as_of: DateLike) -> Column:
    return last_days(ts, as_of, 1)


def last_full_month(ts: Column, as_of: DateLike) -> Column:
    """The calendar month before the one of ``as_of``."""
    first = as_date(as_of).replace(day=1)
    previous = (first - dt.timedelta(days=1)).replace(day=1)
    return (ts >= F.lit(previous)) & (ts < F.lit(first))


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_boundaries(start: Column, end: Column) -> Column:
    """Months between two dates counted as crossed month boundaries, whatever the days of month."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def years_back(as_of: DateLike, months: int) -> dt.date:
    """``as_of`` less a number of months, clipped to the last day of the month."""
    base = as_date(as_of)
    index = base.year * 12 + base.month - 1 - months
    year, month = divmod(index, 12)
    nxt = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return dt.date(year, month + 1, min(base.day, (nxt - dt.timedelta(days=1)).day))


def date_spine(spark: SparkSession, start: DateLike, end: DateLike, step: str = "1 day", name: str = "date") -> DataFrame:
    """One row per step from ``start`` through ``end``."""
    return spark.range(1).select(
        F.explode(F.sequence(day(start), day(end), F.expr(f"interval {step}"))).alias(name)
    )


def calendar_spine(spark: SparkSession, start: DateLike, end: DateLike) -> DataFrame:
    """Days with their month and year buckets and true month end."""
    return date_spine(spark, start, end).select(
        "date",
        month_text(F.col("date")).alias("month"),
        F.year("date").alias("year"),
        F.last_day("date").alias("month_end"),
        (F.col("date") == F.last_day("date")).alias("is_month_end"),
    )


def is_business_day(date: Column, holidays: Iterable[DateLike] = ()) -> Column:
    """Monday to Friday and not in the holiday list."""
    closed = [as_date(h) for h in holidays]
    weekday = ~F.dayofweek(date).isin(1, 7)
    return weekday & ~date.isin(closed) if closed else weekday


def previous_business_day(as_of: DateLike, holidays: Iterable[DateLike] = ()) -> dt.date:
    """The last business day before ``as_of``."""
    closed = {as_date(h) for h in holidays}
    probe = as_date(as_of) - dt.timedelta(days=1)
    while probe.weekday() >= 5 or probe in closed:
        probe -= dt.timedelta(days=1)
    return probe


def cycle_start(now: dt.datetime, cut_hour: int = 14, holidays: Iterable[DateLike] = ()) -> dt.datetime:
    """Start of the settlement cycle that ``now`` falls in: the last business-day cut at ``cut_hour``."""
    closed = {as_date(h) for h in holidays}
    today = now.date()
    open_today = today.weekday() < 5 and today not in closed
    cut_day = today if open_today and now.hour >= cut_hour else previous_business_day(today, closed)
    return dt.datetime.combine(cut_day, dt.time(cut_hour))


def with_previous_business_day(days: DataFrame, holidays: Iterable[DateLike] = ()) -> DataFrame:
    """Adds the last business day before each ``date``. ``days`` is a calendar, one row per day without gaps.

    The carry is one window over the calendar, which holds 366 rows a year however large the data are.
    """
    from pyspark.sql import Window

    carry = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    open_day = F.when(is_business_day(F.col("date"), holidays), F.col("date"))
    return days.withColumn("previous_business_day", F.last(open_day, ignorenulls=True).over(carry))
