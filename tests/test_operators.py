import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coffer.operators import customer, kpi, loans, marts, risk, staff, wallets


def _clients(spark):
    return spark.createDataFrame(
        [(1, "A", "Active", dt.date(2000, 1, 1)), (2, "A", "Closed", dt.date(2000, 1, 1)),
         (3, "Unclassified", "Active", dt.date(2000, 1, 1)), (4, "B", "Active", dt.date(2000, 1, 31))],
        "client_id long, client_category string, client_status string, activation_date date",
    )


def _txns(spark):
    day = lambda s: dt.datetime.fromisoformat(s)
    return spark.createDataFrame(
        [(1, 1, Decimal(10), day("2001-07-01")), (1, 2, Decimal(5), day("2001-08-01")), (1, 1, Decimal(7), day("2000-08-01")),
         (1, 9, Decimal(99), day("2001-07-01")), (2, 1, Decimal(1), day("2001-07-01")), (3, 1, Decimal(1), day("2001-07-01")),
         (4, 1, Decimal(3), day("2000-08-02"))],
        "client_id long, type_enum int, amount decimal(18,2), transaction_date timestamp_ntz",
    )


def test_rfm_base_filters(spark, rows):
    got = customer.rfm_base(_clients(spark), _txns(spark), "2001-08-02").select("client_id", "frequency", "monetary", "recency")
    assert rows(got) == [(1, 2, Decimal(15), 1), (4, 1, Decimal(3), 365)]


def test_rfm_base_repeats_per_account_only_on_request(spark, rows):
    accounts = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (4, 13)], "client_id long, account_id long")
    got = customer.rfm_base(_clients(spark), _txns(spark), "2001-08-02", None, accounts, match_reference=True)
    assert rows(got.select("client_id", "frequency", "monetary")) == [(1, 6, Decimal(45)), (4, 1, Decimal(3))]


def test_scores_on_cuts(spark):
    base = spark.createDataFrame([(i, i, i, Decimal(i)) for i in range(1, 12)],
                                 "client_id long, recency int, frequency long, monetary decimal(18,2)")
    got = {r["client_id"]: (r["r_score"], r["f_score"], r["m_score"]) for r in customer.rfm_scores(base).collect()}
    assert got[1] == (5, 1, 1) and got[3] == (5, 1, 1) and got[4] == (4, 2, 2) and got[11] == (1, 5, 5)


def test_adoption_reads_each_table_once_and_flags_all_clients(spark):
    clients = spark.createDataFrame([(1, "A"), (2, "B")], "client_id long, client_category string")
    txn = spark.createDataFrame([(1, "MOBILE"), (1, "USSD"), (1, None)], "client_id long, channel string")
    card = spark.createDataFrame([(2,)], "client_id long")
    evidence = {"mobile": (txn, F.col("channel") == "MOBILE"), "ussd": (txn, F.col("channel") == "USSD"), "card": (card, None)}
    got = {r["client_id"]: (r["mobile"], r["ussd"], r["card"]) for r in customer.adoption_matrix(clients, evidence, "2001-01-01").collect()}
    assert got == {1: ("1", "1", "0"), 2: ("0", "0", "1")}


def test_period_rule(spark):
    days = ["2000-12-31", "2001-01-01", "2001-07-31", "2001-08-01", "2001-08-02", "2001-08-03"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days], "ts timestamp_ntz")
    n = [F.count(F.lit(1)).alias("n")]
    monthly = {r["month"]: r["n"] for r in kpi.period_kpi(df, "ts", "monthly", n, "2001-08-02").collect()}
    ytd = {str(r["date"]): r["n"] for r in kpi.period_kpi(df, "ts", "ytd", n, "2001-08-02").collect()}
    assert monthly == {"2000-12": 1, "2001-01": 1, "2001-07": 1}
    assert set(ytd) == set(days[1:5])
    with pytest.raises(ValueError):
        kpi.period_kpi(df, "ts", "weekly", n, "2001-08-02")


def test_top_by_period_keeps_ties(spark, rows):
    at = dt.datetime(2001, 1, 5)
    df = spark.createDataFrame([(at, "a"), (at, "a"), (at, "b"), (at, "b"), (at, "c")], "ts timestamp_ntz, item string")
    assert rows(kpi.top_by_period(df, "ts", "monthly", "item", "2001-08-02", "n")) == [("2001-01", "a", 2), ("2001-01", "b", 2)]


def test_quota(spark):
    at = dt.datetime(2001, 1, 5)
    df = spark.createDataFrame([(at, "p")] * 52 + [(at, "q")] * 3, "ts timestamp_ntz, party string")
    row = kpi.quota_by_period(df, "ts", "monthly", "party", 50, "2001-08-02").first()
    assert (row["total_transfers"], row["free_transfers"], row["additional_transfers"]) == (55, 53, 2)


def test_mean_per_customer_is_whole(spark):
    df = spark.createDataFrame([("x",)] * 5 + [("y",)] * 2, "c string")
    row = df.agg(*kpi.customers_and_mean("c")).first()
    assert (row["total_customers"], row["avg_transactions_per_customer"]) == (2, 3)


def test_either_end_matches_or_join(spark, rows):
    transfers = spark.createDataFrame([(1, 10, 11), (2, 12, 12), (3, 13, None), (4, None, 14), (5, 98, 99)], "t int, f int, o int")
    legs = spark.createDataFrame([(10,), (11,), (12,), (13,), (14,)], "leg int")
    got = marts.either_end(transfers, legs, "f", "o", "leg").select("t", "leg")
    transfers.createOrReplaceTempView("tr")
    legs.createOrReplaceTempView("lg")
    want = spark.sql("SELECT t, leg FROM tr JOIN lg ON leg = o OR leg = f")
    assert rows(got) == rows(want)


def test_segment_share_is_cut_to_whole_percent(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)], "segment string")
    got = {r["segment"]: (r["clients"], r["share_percent"]) for r in customer.segment_counts(df).collect()}
    assert got == {"a": (2, 66), "b": (1, 33)}


def test_band_alerts_once_per_band_and_day(spark):
    day = dt.date(2024, 1, 1)
    at = lambda m: dt.datetime(2024, 1, 1, 8, m)
    amounts = [40, 10, 5, 5, 31, 20]  # 40, 50, 55, 60, 91, 111
    events = spark.createDataFrame([(day, at(i), i, Decimal(a)) for i, a in enumerate(amounts)],
                                   "date date, ts timestamp_ntz, id int, amount decimal(18,2)")
    got = {r["band"]: (r["event_id"], r["amount_used"]) for r in risk.limit_band_alerts(events, 100).collect()}
    assert got == {50: (1, 50), 60: (3, 60), 90: (4, 91)}


def test_settlement_position_of_an_empty_cycle(spark):
    none = spark.createDataFrame([], "ts timestamp_ntz, amount decimal(18,2)")
    row = risk.settlement_position(none, none, dt.datetime(2024, 1, 24, 15), 100).first()
    assert (row["out_volume"], row["difference"], row["percent_consumption"], row["alert"]) == (0, 0, 0.0, False)


def test_repeat_alerts_need_two_hits_in_one_direction(spark):
    at = dt.datetime(2001, 1, 1)
    alerts = spark.createDataFrame(
        [(1, "Tier 3", "deposit", at), (1, "Tier 3", "deposit", at), (1, "Tier 3", "withdrawal", at), (2, "Tier 3", "deposit", at),
         (3, "Tier 1", "deposit", at), (3, "Tier 1", "deposit", at)],
        "client_id int, client_tier string, transaction_type string, transaction_date timestamp_ntz",
    )
    got = risk.repeat_alerts(alerts).collect()
    assert [(r["client_id"], r["transaction_type"], r["hits"]) for r in got] == [(1, "deposit", 2)] * 2


def test_limit_increase_looks_at_both_limits(spark):
    schema = "client_id int, daily_withdraw_limit decimal(18,2), max_transaction_limit decimal(18,2)"
    now = spark.createDataFrame([(1, Decimal(5), Decimal(5)), (2, Decimal(4), Decimal(6)), (3, Decimal(5), Decimal(4))], schema)
    old = spark.createDataFrame([(1, Decimal(5), Decimal(5)), (2, Decimal(5), Decimal(5)), (3, Decimal(5), Decimal(5))], schema)
    assert [r["client_id"] for r in risk.limit_increases(now, old).collect()] == [2]


def test_collections_spans(spark):
    row = lambda d, v: (1, 1, "No", Decimal(v), dt.datetime.fromisoformat(d))
    df = spark.createDataFrame([row("2001-07-03", 1), row("2001-07-02", 2), row("2001-05-04", 4), row("2001-05-03", 8), row("2001-08-02", 16)],
                               "account_id int, type_enum int, is_reversed string, amount decimal(18,2), transaction_date timestamp_ntz")
    got = loans.collections(df, "2001-08-02").first()
    assert (got["one_month_collection"], got["three_month_collection"]) == (17, 23)


def test_deposit_drive_has_others_and_idle_staff(spark):
    txns = spark.createDataFrame(
        [(1, 1, 36, Decimal(5), dt.datetime(2001, 7, 5)), (1, 2, 33, Decimal(2), dt.datetime(2001, 7, 5)), (2, 1, 33, Decimal(7), dt.datetime(2001, 7, 6))],
        "client_id int, type_enum int, product_id int, amount decimal(18,2), transaction_date timestamp_ntz",
    )
    people = spark.createDataFrame([(1, 50), (2, None)], "client_id int, referred_by_id int")
    team = spark.createDataFrame([(50, "S"), (51, "Idle")], "staff_id int, staff_name string")
    got = {r["staff_id"]: (r["total_inflow"], r["total_outflow"], r["fd_inflow"])
           for r in staff.deposit_drive(txns, people, team, 36, "2001-07-01", "2001-08-01").collect()}
    assert got == {"50": (5, 2, 5), "51": (0, 0, 0), "others": (7, 0, 0)}


def test_kpi_rows(spark):
    one = spark.createDataFrame([(1, "x")], "`A b` int, c string")
    assert {(r["metric"], r["value"]) for r in wallets.kpi_rows(one).collect()} == {("A b", "1"), ("c", "x")}


def test_plans_have_no_nested_loop_join(spark):
    import __spark_entry__ as entry

    for name in ("liquidation_or_join", "mart_product_liquidation_monthly", "settlement_position", "rfm_scores", "loan_star_enrich"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_period_filter_reaches_the_scan(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["mart_intrabank_monthly"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate,2001-08-01" in plan
    assert "o_orderstatus" not in plan.split("ReadSchema")[1]


def test_a_list_beyond_the_broadcast_limit_reaches_the_scan_as_a_bloom_filter(spark, tmp_path):
    from coffer.operators import joins

    paths = [str(tmp_path / n) for n in ("large", "listed")]
    spark.range(200_000).selectExpr("id % 50000 as k", "id as v", "cast(id as string) as w").write.parquet(paths[0])
    spark.range(3000).selectExpr("id * 7 as k", "id % 10 as kind").unionByName(
        spark.createDataFrame([(None, 1)], "k long, kind long")).write.parquet(paths[1])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        large, listed = map(spark.read.parquet, paths)
        found = joins.of_listed_keys(large, listed.filter("kind = 1"), "k")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
        want = {i * 7 for i in range(3000) if i % 10 == 1}
        assert found.count() == sum(1 for v in range(200_000) if v % 50000 in want)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
