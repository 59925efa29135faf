import datetime as dt

import pytest
from pyspark.sql import functions as F

from coffer.functions import bands, dates, text
from coffer.functions.measures import volume_value_by


def _map(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.withColumn("o", build(F.col("v"))).orderBy("i").collect()]


def test_generation_edges(spark):
    got = _map(spark, [None, "1-1-1944", "1-1-1945", "1-1-1946", "1-1-1964", "1-1-1965", "1-1-1979", "1-1-1980", "1-1-1994",
                       "1-1-1995", "1-1-2012", "1-1-2013"], bands.generation_cohort)
    assert got == ["Not Found", "Silent Generation", None, "Baby Boomers", "Baby Boomers", "Generation X", "Generation X",
                   "Millennials", "Millennials", "Generation Z", "Generation Z", "Generation Alpha"]


def test_activity_edges(spark):
    assert _map(spark, [0, 30, 31], bands.stickiness, "int") == ["sticky", "sticky", "non sticky"]
    assert _map(spark, [90, 91, 180, 181, None], bands.activity_status, "int") == [
        "active", "inactive", "inactive", "dormant", "dormant"]


def test_risk_edges(spark):
    assert _map(spark, [1.5, 1.51, 3.99, 4.0, None], bands.risk_band, "double") == [
        "Low risk", "Medium risk", "Medium risk", "High risk", None]


def test_maturity_edges(spark):
    start = dt.date(2001, 8, 2)
    days = [start + dt.timedelta(days=n) for n in (61, 60, 31, 30, -5)]
    assert _map(spark, days, lambda c: bands.maturity_band(c, start), "date") == [
        "above 60 days", "btw 31-60 days", "btw 31-60 days", "30 days and below", "30 days and below"]


def test_first_valid_account(spark):
    df = spark.createDataFrame([("0", "7"), (" ", "0"), (None, " 8 "), ("5", "6")], "a string, b string")
    got = [r[0] for r in df.select(bands.first_valid_account(F.col("a"), F.col("b"))).collect()]
    assert got == ["7", None, "8", "5"]


def test_card_kind_of_missing_charge(spark):
    assert _map(spark, [1000, 1001, None], bands.card_type_by_charge, "int") == ["Virtual", "Physical", "Unclassified"]


def test_expiry_at_year_end(spark):
    got = _map(spark, ["2312", "2401", "2412", "2501"], lambda c: bands.expires_in_year(c, dt.date(2024, 12, 31)))
    assert got == [False, True, True, False]


def test_biller_rules_first_match_wins_and_case_is_ignored(spark):
    got = _map(spark, ["bet 9ja and EKO disco", "Eko Electric", "Kano and ikeja", "unknown biller with a very long name"],
               lambda c: text.biller_name(F.upper(c), c))
    assert got == ["BET9JA", "EKO ELECTRIC", "IKEJA ELECTRIC", "unknown biller with a very long name"]
    cut = _map(spark, ["unknown biller with a very long name"], lambda c: text.biller_name(F.upper(c), c, 27))
    assert cut == ["unknown biller with a very "]


def test_codes_are_classified_once_and_purchases_without_a_code_are_kept(spark):
    from coffer.operators import bills

    rows = [(1, "MTN topup", "r"), (2, "Blank", "dstv box"), (3, None, None), (4, "corner shop", None), (5, "glo", "x"), (6, "MTN topup", "z")]
    df = spark.createDataFrame(rows, "id int, biller_code string, remarks string")
    got = {r["id"]: (r["biller_code"], r["biller_by_rule"]) for r in bills.bills_transactions(df).collect()}
    assert got == {2: ("dstv box", "DSTV CABLE SERVICE"), 3: (None, None), 4: ("corner shop", "corner shop")}
    assert {r["id"]: r["brand"] for r in bills.airtime_transactions(df).collect()} == {1: "MTN", 5: "GLO", 6: "MTN"}
    named = {r["id"]: r["biller_by_rule"] for r in bills.with_biller(df).collect()}
    assert named[3] is None and named[1] == "MTN topup" and len(named) == 6
    codegen = bills.bills_transactions(df)._jdf.queryExecution().debug().codegenToSeq()
    stats = [codegen.apply(i)._3().maxMethodCodeSize() for i in range(codegen.length())]
    assert max(stats, default=0) < 4000


def test_biller_rules_are_thirty_seven(spark):
    assert len(text.BILLER_RULES) == 37
    marks = [m for _, ms in text.BILLER_RULES for m in ms]
    assert all(m == m.upper() for m in marks)


def test_segments_cover_all_score_pairs_once(spark):
    import re

    for r in range(1, 6):
        for f in range(1, 6):
            hits = [name for pattern, name in text.RFM_SEGMENTS if re.fullmatch(pattern, f"{r}{f}")]
            assert len(hits) == 1, (r, f, hits)
    got = _map(spark, ["11", "55", "33", "45", "52", "60"], text.rfm_segment)
    assert got == ["Hibernating", "Champions", "Need Attention", "Loyal Customers", "Potential Loyalists", None]


def test_list_text_to_rows(spark, rows):
    df = spark.createDataFrame([("w", "[1, 2,3]")], "n string, l string")
    assert rows(text.explode_list_text(df, "l", "a").select("n", "a")) == [("w", "1"), ("w", "2"), ("w", "3")]


def test_code_or_remarks(spark):
    df = spark.createDataFrame([("Blank", "r"), (None, "r"), ("MTN", "r")], "c string, r string")
    assert [x[0] for x in df.select(text.code_or_remarks(F.col("c"), F.col("r"))).collect()] == ["r", "r", "MTN"]


def test_suffix_resource(spark):
    df = spark.createDataFrame([("/a", "x/y"), ("/a", "xy"), ("/b", "x/y")], "r string, v string")
    got = [x[0] for x in df.select(text.suffix_resource(F.col("r"), F.col("v"), ["/a"])).collect()]
    assert got == ["/a-account", "/a", "/b"]


def test_clip_strings(spark):
    df = spark.createDataFrame([("abcdef", "abcdef", 1)], "a string, b string, n int")
    assert tuple(text.clip_strings(df, {"a": 2}).first()) == ("ab", "abcdef", 1)
    assert tuple(text.clip_strings(df, 3).first()) == ("abc", "abc", 1)


def test_month_boundaries_ignore_days(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, 31), dt.date(2001, 2, 1)), (dt.date(2000, 12, 1), dt.date(2002, 1, 31))],
                               "a date, b date")
    assert [r[0] for r in df.select(dates.month_boundaries(F.col("a"), F.col("b"))).collect()] == [1, 13]


@pytest.mark.parametrize("day,months,want", [
    ("2001-08-02", 12, "2000-08-02"), ("2001-03-31", 1, "2001-02-28"), ("2000-03-31", 1, "2000-02-29"),
    ("2001-12-31", 1, "2001-11-30"), ("2001-01-15", 1, "2000-12-15"),
])
def test_years_back(day, months, want):
    assert dates.years_back(day, months) == dt.date.fromisoformat(want)


def test_cycle_start_over_weekend_and_holidays():
    holidays = ["2024-01-26"]
    at = lambda s: dates.cycle_start(dt.datetime.fromisoformat(s), 14, holidays)
    assert at("2024-01-24 15:00") == dt.datetime(2024, 1, 24, 14)
    assert at("2024-01-24 13:59") == dt.datetime(2024, 1, 23, 14)
    assert at("2024-01-28 16:00") == dt.datetime(2024, 1, 25, 14)  # Sunday after a holiday Friday
    assert at("2024-01-29 10:30") == dt.datetime(2024, 1, 25, 14)
    assert at("2024-01-29 14:00") == dt.datetime(2024, 1, 29, 14)


def test_previous_business_day_column_agrees_with_the_function(spark):
    holidays = ["2024-01-01", "2024-01-26"]
    spine = dates.date_spine(spark, "2023-12-15", "2024-02-10")
    got = {r["date"]: r["previous_business_day"] for r in dates.with_previous_business_day(spine, holidays).collect()}
    for day in (dt.date(2023, 12, 26), dt.date(2024, 1, 2), dt.date(2024, 1, 28), dt.date(2024, 2, 5)):
        assert got[day] == dates.previous_business_day(day, holidays)


def test_channel_measures_count_only_named_channels(spark):
    df = spark.createDataFrame([("MOBILE", 5), ("USSD", 7), (None, 9)], "channel string, amount int")
    row = df.agg(*volume_value_by("channel", ["MOBILE", "CHATBOT"])).first()
    assert (row["mobile_volume"], row["mobile_value"], row["chatbot_volume"], row["chatbot_value"]) == (1, 5, 0, 0)
    assert (row["total_volume"], row["total_value"]) == (3, 21)


def test_percent_of_is_half_up_in_cents_and_wide(spark):
    from decimal import Decimal

    from coffer.functions.measures import percent_of

    cases = [("1.00", "3.00", 33.33), ("338.49", "1.00", 33849.0), ("0.01", "80.00", 0.01), ("0.01", "200.00", 0.01),
             ("-0.01", "200.00", -0.01), ("0.01", "201.00", 0.0), ("0.00", "5.00", 0.0),
             ("90000000000000000.00", "90000000.00", 1e11)]
    df = spark.createDataFrame([(i, Decimal(a), Decimal(b)) for i, (a, b, _) in enumerate(cases)],
                               "i int, a decimal(28,2), b decimal(28,2)")
    got = [r[0] for r in df.orderBy("i").select(percent_of(F.col("a"), F.col("b"))).collect()]
    assert got == [c[2] for c in cases]
