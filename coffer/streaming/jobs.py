"""Streaming forms of the poll, the time slices, the band alerts and the settlement position.

``read_files`` gives a stream; each ``run_*`` drives one job over all input there is and stops. Positions and state live in
the checkpoint folder, so a job goes on where it was. Every micro-batch writes a part of its own, ``batch=<id>``, which a
repeated batch replaces. Unless a lateness is asked for, nothing waits for a watermark and no row is dropped for being late:
in whatever order rows come, what is read back equals the batch query over the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from coffer.functions.dates import is_business_day
from coffer.operators.risk import first_in_bands
from coffer.operators.running import running_total_over_day


def read_files(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None, names: str = "*.parquet"
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", names)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> None:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer.outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def _replace_part(df: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batch={batch_id}")


def parts(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """What the batches (those before a number) wrote; ``batch`` is its number. Batches count from 0 without gaps."""
    if before == 0:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(path)
    return whole if before is None else whole.filter(F.col("batch") < before)


#: Ids of a folder of the table that ``run_append`` writes.
ID_RANGE = 1 << 20
KEY_RANGE = T.StructField("key_range", T.LongType())


def loaded_before(spark: SparkSession, path: str, schema: T.StructType, key: str, ranges: Sequence[int], batch_id: int) -> DataFrame:
    """Keys in some ranges that earlier batches wrote. The range is a folder, so other ranges are not listed as files to read."""
    there = parts(spark, path, T.StructType([schema[key], KEY_RANGE]), batch_id)
    return there.filter(F.col("key_range").isin(list(ranges))).select(key)


def run_append(
    stream: DataFrame, path: str, checkpoint: str, key: str, width: int = ID_RANGE, repeats_within: str | None = None
) -> None:
    """New rows once each: a key that the table has is not written again, however late it comes.

    ``key`` is an integer. The table lies in folders of ``width`` keys, and a batch is compared with the folders that its
    keys fall in only: at most ``width`` rows each, however large the table is. Which folders those are goes to the driver,
    which names each of them anyway when the batch is committed. Null keys are kept all, in a folder of their own.

    ``repeats_within`` ("2 hours") also drops repeats that arrive so soon after each other from state, before they are
    compared with the table. State is timed by arrival, so no row is ever too late for it.
    """
    if repeats_within:
        timed = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", repeats_within)
        # rows without a key are not repeats of each other: they get one apiece
        own = F.coalesce(F.col(key).cast("string"), F.uuid())
        stream = timed.withColumn("_own", own).dropDuplicatesWithinWatermark(["_own"]).drop("_arrived", "_own")

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        ranged = batch.withColumn("key_range", F.floor(F.col(key) / width))
        known = ranged.filter(F.col(key).isNotNull()).dropDuplicates([key])
        ranges = [r["key_range"] for r in known.select("key_range").distinct().collect()]
        fresh = known.join(loaded_before(spark, path, schema, key, ranges, batch_id), key, "left_anti").select(*ranged.columns)
        _replace_part(fresh.unionByName(ranged.filter(F.col(key).isNull())), path, batch_id, ["key_range"])

    _run(stream, step, checkpoint, "append")


def appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that ``run_append`` keeps."""
    return parts(spark, path, T.StructType([*schema.fields, KEY_RANGE])).select(*schema.fieldNames())


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Keeps an aggregation up to date: each batch writes the groups that it changed, with their new values."""
    _run(stream, lambda batch, batch_id: _replace_part(batch, path, batch_id), checkpoint, "update")


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last value of every group that ``run_updates`` wrote, open windows too."""
    values = [f.name for f in schema.fields if f.name not in keys]
    newest = F.max_by(F.struct(*values), F.col("batch")).alias("v")
    return parts(spark, path, schema).groupBy(*keys).agg(newest).select(*keys, "v.*")


def tumbling_slices(
    stream: DataFrame, ts: str, keys: Sequence[str], measures: Sequence[Column], minutes: int = 10, lateness: str | None = None,
    offset_minutes: int = 0,
) -> DataFrame:
    """Measures by tumbling slice, for ``run_updates``.

    State holds one row per slice and key. ``lateness`` bounds it: slices older than that are let go, and rows that come
    later than that no longer count. Without it every row counts.
    """
    window = F.window(ts, f"{minutes} minutes", startTime=f"{offset_minutes} minutes")
    timed = stream.withWatermark(ts, lateness) if lateness else stream
    return timed.groupBy(window.alias("w"), *keys).agg(*measures).select(F.col("w.start").alias("slice_start"), "*").drop("w")


def with_cycle(stream: DataFrame, ts: str, calendar: DataFrame, cut_hour: int = 14, holidays: Sequence[str] = ()) -> DataFrame:
    """Adds ``cycle_start``: the last cut, at ``cut_hour`` of a business day, at or before the time.

    ``calendar`` has a column ``date``, one row per day without gaps, with a business day before the first time and the day
    of the last one. A closed spell may be of any length. A time that the calendar does not reach raises; an unknown time
    has no cycle.
    """
    carry = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # 366 rows a year
    open_day = F.when(is_business_day(F.col("date"), holidays), F.col("date"))
    last_cut = calendar.select(F.to_date("date").alias("date")).withColumn("cut_day", F.last(open_day, ignorenulls=True).over(carry))
    cut = F.make_timestamp(F.year("cut_day"), F.month("cut_day"), F.dayofmonth("cut_day"), F.lit(cut_hour), F.lit(0), F.lit(0))
    cuts = last_cut.select(F.col("date").alias("_cut_date"), cut.alias("_cycle"))
    moved = stream.withColumn("_cut_date", F.to_date(F.col(ts) - F.expr(f"interval {cut_hour} hours")))
    missed = F.raise_error(F.concat(F.lit("the calendar has no cut for "), F.col(ts).cast("string"))).cast("timestamp")
    cycle = F.when(F.col(ts).isNull() | F.col("_cycle").isNotNull(), F.col("_cycle")).otherwise(missed)
    return moved.join(cuts, "_cut_date", "left").withColumn("cycle_start", cycle).drop("_cut_date", "_cycle")


def cycle_totals(timed: DataFrame) -> DataFrame:
    """Outward and inward totals per settlement cycle, for ``run_updates``. Needs ``cycle_start``, ``side``, ``amount``."""
    out, inn = F.col("side") == "out", F.col("side") == "in"
    return timed.groupBy("cycle_start").agg(
        F.count(F.when(out, 1)).alias("out_volume"), F.count(F.when(inn, 1)).alias("in_volume"),
        F.sum(F.when(out, F.col("amount"))).alias("out_value"), F.sum(F.when(inn, F.col("amount"))).alias("in_value"),
    )


ALERT_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("band", T.IntegerType()), T.StructField("reached_at", T.TimestampType()),
    T.StructField("event_id", T.LongType()), T.StructField("amount_used", T.DecimalType(28, 2)),
])
EVENT_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType()), T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("slice", T.IntegerType()), T.StructField("date", T.DateType()),
])
_DAY_SCHEMA = T.StructType([T.StructField("date", T.DateType())])
_SUMS = ("net", "up", "down")
#: What a day keeps between batches: its slices in order, and the cents moved in each, in all, upwards and downwards.
_STATE = "slices array<int>, net array<long>, up array<long>, down array<long>"


def slices_to_search(sums: pd.DataFrame, limit: float, first_band: int) -> pd.DataFrame:
    """Slices of a day in which some band may be reached first, with the cents used before each.

    ``sums``: slice, net, up, down in cents, in order of slices. Inside a slice the total stays between what was used before
    it plus ``down`` and plus ``up``, so only slices where that spans the band can hold its first event; and none behind the
    first slice that ends inside the band, as its last event is in the band.
    """
    before = sums["net"].cumsum() - sums["net"]
    low, high, end = before + sums["down"], before + sums["up"], before + sums["net"]
    wanted = np.zeros(len(sums), bool)
    for band in range(first_band, 100, 10):
        # a cent of room on either side, as the edges need not be whole cents
        bottom, top = band * float(limit), (band + 10) * float(limit)
        spans = (high >= bottom - 1) & (low <= top + 1)
        ends_inside = (end >= bottom + 1) & (end <= top - 1)
        wanted |= (spans & (ends_inside.cumsum() - ends_inside == 0)).to_numpy()
    return pd.DataFrame({"slice": sums["slice"], "before": before})[wanted]


def _combined(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums per day and slice within a task, so that a day sends few rows to its state."""
    for piece in pieces:
        net = piece["net"]
        yield piece.assign(up=net.clip(lower=0), down=net.clip(upper=0)).groupby(["date", "slice"], as_index=False)[[*_SUMS]].sum()


def _day_state(limit: float, first_band: int, timed: bool):
    """The keyed step: adds new sums to a day's slices and gives the slices to search, and a row that names the day."""

    def step(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        sums = pd.concat(pieces)
        if timed:
            closes = int(sums["closes_ms"].iloc[0])
            if closes <= state.getCurrentWatermarkMs():
                return  # the day was closed: its rows are kept, its alerts stand
            state.setTimeoutTimestamp(closes)
        if state.exists:
            sums = pd.concat([sums, pd.DataFrame(dict(zip(("slice", *_SUMS), state.get)))])
        sums = sums.groupby("slice", as_index=False)[[*_SUMS]].sum().sort_values("slice")
        state.update(tuple(sums[c].tolist() for c in ("slice", *_SUMS)))
        found = slices_to_search(sums, limit, first_band)
        named = pd.DataFrame({"slice": [None, *found["slice"].tolist()], "before": [None, *found["before"].tolist()]}, dtype="Int64")
        yield named.assign(date=key[0])[["date", "slice", "before"]]

    return step


def run_band_alerts(
    stream: DataFrame, path: str, checkpoint: str, limit: float, first_band: int = 50, slice_minutes: int = 10,
    lateness: str | None = None,
) -> None:
    """One alert per day and 10 % band of the limit, by the rule of the batch form, in whatever order events come.

    ``stream``: date, ts, id, amount (in cents at the finest); date is the day of ts. Keyed state holds the sums of each
    day's slices, at most 1,440 / ``slice_minutes`` of them, to which a task sends one row per slice. A day that gets events
    names the slices in which a band may now be reached first; only those are read again, from the stored events in the
    folder of the day, and the day's alerts are told anew. ``band_alerts`` reads what holds now.

    ``lateness`` closes days by an event-time timer: a day's state goes when events have come of a day that ends so much
    later, and what comes then is stored but changes no alert. Without it days stay open.
    """
    minute = F.hour("ts") * 60 + F.minute("ts")
    events = stream.select(
        F.lit(None).cast("long").alias("before"), "ts", F.col("id").cast("long").alias("id"),
        F.col("amount").cast("decimal(18,2)").alias("amount"), F.floor(minute / slice_minutes).cast("int").alias("slice"), "date",
    )
    cents = events.select("date", "slice", (F.col("amount") * 100).cast("long").alias("net"))
    sums = cents.mapInPandas(_combined, "date date, slice int, net long, up long, down long")
    timeout = GroupStateTimeout.NoTimeout
    if lateness:
        closes = F.date_add("date", 1).cast("timestamp")
        sums = sums.withColumns({"closes": closes, "closes_ms": F.unix_millis(closes)}).withWatermark("closes", lateness)
        timeout = GroupStateTimeout.EventTimeTimeout
    touched = sums.groupBy("date").applyInPandasWithState(
        _day_state(limit * 1.0, first_band, lateness is not None), "date date, slice int, before long", _STATE, "update", timeout
    )
    both = events.withColumn("is_event", F.lit(True)).unionByName(
        touched.withColumn("is_event", F.lit(False)), allowMissingColumns=True
    )

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, batch = batch.sparkSession, batch.persist()
        named = batch.filter(~F.col("is_event")).select("date", "slice", "before")
        _replace_part(batch.filter("is_event").select(*EVENT_SCHEMA.fieldNames()), f"{path}/events", batch_id, ["date"])
        days = [r["date"] for r in named.select("date").distinct().collect()]  # the batch wrote a folder for each
        stored = parts(spark, f"{path}/events", EVENT_SCHEMA, batch_id + 1).filter(F.col("date").isin(days))
        searched = stored.join(named.filter("slice is not null"), ["date", "slice"]).withColumn("within", F.struct("date", "slice"))
        running = running_total_over_day(searched, "within", "ts", "id", "amount", "used")
        found = first_in_bands(running.withColumn("used", F.col("used") + F.col("before") / F.lit(100).cast("decimal(3,0)")), limit, first_band)
        shaped = found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA.fields])
        _replace_part(shaped, f"{path}/alerts", batch_id)
        _replace_part(spark.createDataFrame([(d,) for d in days], _DAY_SCHEMA), f"{path}/days", batch_id)
        batch.unpersist()

    _run(both, step, checkpoint, "update")


def band_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts as they stand: those of the last batch that told each day."""
    last = parts(spark, f"{path}/days", _DAY_SCHEMA).groupBy("date").agg(F.max("batch").alias("batch"))
    return parts(spark, f"{path}/alerts", ALERT_SCHEMA).join(last, ["date", "batch"], "left_semi").drop("batch")
