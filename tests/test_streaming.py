import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from coffer.functions import dates
from coffer.operators import risk
from coffer.streaming import jobs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SCHEMA = "id long, ts timestamp, amount decimal(18,2)"


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _folders(tmp_path):
    return tuple(str(tmp_path / n) for n in ("src", "out", "state"))


def test_append_goes_on_where_it_stopped_and_drops_repeats(spark, tmp_path):
    src, out, state = _folders(tmp_path)
    at = dt.datetime(2024, 1, 1, 10)
    schema = spark.createDataFrame([], SCHEMA).schema
    run = lambda: jobs.run_append(jobs.read_files(spark, src, SCHEMA), out, state, "id")
    ids = lambda: sorted(r["id"] for r in jobs.appended(spark, out, schema).collect())
    _write(spark, src, [(1, at, Decimal(1)), (2, at, Decimal(1)), (2, at, Decimal(1))])
    run()
    assert ids() == [1, 2]
    late = at - dt.timedelta(days=400)
    _write(spark, src, [(2, at, Decimal(1)), (3, late, Decimal(1))])
    run()
    assert ids() == [1, 2, 3]


def test_slices_equal_the_batch_slices_over_several_batches_and_late_rows(spark, tmp_path):
    src, out, state = _folders(tmp_path)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=3 * (i * 7 % 40)), Decimal(i)) for i in range(40)]
    measures = [F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")]
    for part in (rows[:15], rows[15:16], rows[16:]):
        _write(spark, src, part)
        stream = jobs.tumbling_slices(jobs.read_files(spark, src, SCHEMA), "ts", [], measures)
        jobs.run_updates(stream, out, state)
    got = {r["slice_start"]: (r["n"], r["amount"]) for r in jobs.latest(spark, out, stream.schema, ["slice_start"]).collect()}
    want = {}
    for _, ts, amount in rows:
        key = ts.replace(minute=ts.minute // 10 * 10)
        n, total = want.get(key, (0, Decimal(0)))
        want[key] = (n + 1, total + amount)
    assert got == want


def test_bands_are_told_once_over_several_batches(spark, tmp_path):
    src, out, state = _folders(tmp_path)
    at = lambda m: dt.datetime(2024, 1, 1, 9, m)
    rows = [(1, at(1), Decimal(30)), (2, at(2), Decimal(25)), (3, at(3), Decimal(2)), (4, at(4), Decimal(-20)), (5, at(5), Decimal(20)),
            (6, at(6), Decimal(30)), (7, at(7), Decimal(4)), (8, at(8), Decimal(30))]
    for part in (rows[:2], rows[2:4], rows[4:7], rows[7:]):
        _write(spark, src, part)
        stream = jobs.read_files(spark, src, SCHEMA).select(F.to_date("ts").alias("date"), "ts", "id", "amount")
        jobs.run_band_alerts(stream, out, state, 100)
    got = sorted((r["band"], r["event_id"], r["amount_used"]) for r in jobs.band_alerts(spark, out).collect())
    events = spark.createDataFrame(rows, SCHEMA).select(F.to_date("ts").alias("date"), "ts", "id", "amount")
    want = sorted((r["band"], r["event_id"], r["amount_used"]) for r in risk.limit_band_alerts(events, 100).collect())
    assert got == want == [(50, 2, Decimal(55)), (80, 6, Decimal(87)), (90, 7, Decimal(91))]


def test_append_reads_only_the_key_ranges_that_a_batch_meets(spark, tmp_path):
    src, out, state = _folders(tmp_path)
    at = dt.datetime(2024, 1, 1, 10)
    schema = spark.createDataFrame([], SCHEMA).schema
    for first in range(0, 500, 100):
        _write(spark, src, [(k, at, Decimal(k)) for k in (*range(first, first + 100), first // 2, 3)])
        jobs.run_append(jobs.read_files(spark, src, SCHEMA), out, state, "id", width=50, repeats_within="1 hour")
    _write(spark, src, [(None, at, Decimal(1)), (None, at, Decimal(1)), (499, at, Decimal(2)), (1000, at, Decimal(0)), (-3, at, Decimal(0))])
    jobs.run_append(jobs.read_files(spark, src, SCHEMA), out, state, "id", width=50, repeats_within="1 hour")
    rows = jobs.appended(spark, out, schema)
    assert rows.schema == schema
    assert sorted(r["id"] for r in rows.filter("id is not null").collect()) == [-3, *range(500), 1000]
    assert rows.filter("id is null").count() == 2
    there = jobs.loaded_before(spark, out, schema, "id", [9, 20], 1000)
    assert "key_range" in there._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    assert there.count() == 51


def _band_rows(spark, rows, limit):
    events = spark.createDataFrame(rows, SCHEMA).select(F.to_date("ts").alias("date"), "ts", "id", "amount")
    return sorted(tuple(r) for r in risk.limit_band_alerts(events, limit).collect())


def test_bands_equal_the_batch_form_whatever_order_events_come_in(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, 10)
    late_first = [[(1, at, Decimal(40)), (2, at + dt.timedelta(hours=4), Decimal(20))], [(3, at - dt.timedelta(hours=1), Decimal(15))]]
    rng = random.Random(5)
    start = dt.datetime(2024, 3, 1)
    rows = [(k, start + dt.timedelta(minutes=rng.randrange(3 * 1440)), Decimal(rng.choice([-900, 250, 777, 1301, 4000])) / 100) for k in range(240)]
    shuffled = rng.sample(rows, len(rows))
    for case, batches in enumerate([late_first, [shuffled[k::5] for k in range(5)]]):
        src, out, state = (f"{f}{case}" for f in _folders(tmp_path))
        for batch in batches:
            _write(spark, src, batch)
        stream = jobs.read_files(spark, src, SCHEMA, files_per_trigger=1).select(F.to_date("ts").alias("date"), "ts", "id", "amount")
        jobs.run_band_alerts(stream, out, state, 100 if case == 0 else 400)
        got = sorted(tuple(r) for r in jobs.band_alerts(spark, out).collect())
        assert got == _band_rows(spark, sum(batches, []), 100 if case == 0 else 400) and got
    assert {(r["band"], r["event_id"]) for r in jobs.band_alerts(spark, f"{_folders(tmp_path)[1]}0").collect()} == {(50, 1), (70, 2)}


def test_a_closed_day_keeps_its_alerts(spark, tmp_path):
    src, out, state = _folders(tmp_path)
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    batches = [[(1, day(1, 9), Decimal(55))], [(2, day(5, 9), Decimal(61))], [(3, day(5, 10), Decimal(1))], [(4, day(1, 8), Decimal(20)), (5, day(5, 8), Decimal(11))]]
    for batch in batches:
        _write(spark, src, batch)
        stream = jobs.read_files(spark, src, SCHEMA).select(F.to_date("ts").alias("date"), "ts", "id", "amount")
        jobs.run_band_alerts(stream, out, state, 100, lateness="1 day")
    got = sorted((str(r["date"]), r["band"], r["event_id"]) for r in jobs.band_alerts(spark, out).collect())
    assert got == [("2024-01-01", 50, 1), ("2024-01-05", 70, 2)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(-40, 60)), min_size=1, max_size=25), st.integers(20, 300))
def test_searched_slices_hold_the_first_event_of_every_band(events, limit):
    events = sorted(events, key=lambda e: e[0])
    first, used = {}, 0
    for place, amount in events:
        used += amount
        band = used * 10 // limit * 10
        if 50 <= band < 100:
            first.setdefault(band, place)
    frame = pd.DataFrame(events, columns=["slice", "net"]).assign(net=lambda f: f["net"] * 100)
    sums = frame.assign(up=frame["net"].clip(lower=0), down=frame["net"].clip(upper=0)).groupby("slice", as_index=False).sum()
    assert set(first.values()) <= set(jobs.slices_to_search(sums, limit, 50)["slice"])


def test_cycles_of_a_long_closed_spell_and_times_beyond_the_calendar(spark):
    closed = tuple(f"2024-01-{d:02d}" for d in range(3, 25))
    calendar = dates.date_spine(spark, "2024-01-01", "2024-02-01")
    times = [(dt.datetime(2024, 1, 24, 20),), (dt.datetime(2024, 1, 2, 14),), (None,)]
    got = {r["ts"]: r["cycle_start"] for r in jobs.with_cycle(spark.createDataFrame(times, "ts timestamp"), "ts", calendar, holidays=closed).collect()}
    assert got == {times[0][0]: dt.datetime(2024, 1, 2, 14), times[1][0]: dt.datetime(2024, 1, 2, 14), None: None}
    for beyond in (dt.datetime(2024, 3, 1, 10), dt.datetime(2024, 1, 1, 10)):
        with pytest.raises(Exception, match="no cut"):
            jobs.with_cycle(spark.createDataFrame([(beyond,)], "ts timestamp"), "ts", calendar).collect()


def test_cycles_begin_at_business_day_cuts(spark):
    times = [dt.datetime(2024, 1, 25, 13), dt.datetime(2024, 1, 25, 14), dt.datetime(2024, 1, 27, 18), dt.datetime(2024, 1, 29, 13, 59),
             dt.datetime(2024, 1, 29, 14)]
    calendar = dates.date_spine(spark, "2024-01-01", "2024-02-01")
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp")
    got = {r["ts"]: r["cycle_start"] for r in jobs.with_cycle(df, "ts", calendar, holidays=("2024-01-26",)).collect()}
    assert got == {t: dates.cycle_start(t, 14, ("2024-01-26",)) for t in times}
