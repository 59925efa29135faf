import datetime as dt
import random
from decimal import Decimal

from coffer.operators import ledger
from coffer.sources import sinks
from coffer.operators.running import running_balance, running_total_over_day

TXN = ("transaction_id long, account_id long, account_no string, product_id int, type_enum int, amount decimal(18,2), "
       "transaction_date timestamp_ntz, is_reversed string")


def _txn(spark, rows):
    return spark.createDataFrame(
        [(i, a, str(a), 33, e, Decimal(str(v)), dt.datetime.fromisoformat(d), "No") for i, a, e, v, d in rows], TXN
    )


def test_running_balance_of_a_hot_account_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        account = 1 if rng.random() < 0.5 else rng.randint(2, 9)
        day = f"2001-01-{rng.randint(1, 6):02d}"
        rows.append((i, account, rng.choice([1, 2]), round(rng.uniform(1, 100), 2), day))
    want, balance = {}, {}
    for i, a, e, v, _ in sorted(rows, key=lambda r: (r[4], r[0])):
        balance[a] = balance.get(a, Decimal(0)) + (1 if e == 1 else -1) * Decimal(str(v))
        want[i] = balance[a]
    df = _txn(spark, rows).selectExpr("*", "if(type_enum = 1, amount, -amount) as signed")
    for width in (7, 1 << 20):  # many slices per day, and one
        got = running_balance(df, "account_id", "transaction_date", "transaction_id", "signed", "bal", width)
        assert {r["transaction_id"]: r["bal"] for r in got.collect()} == want
    last = {r["account_id"]: r["running_balance"] for r in ledger.latest_running_balance(_txn(spark, rows)).collect()}
    assert last == balance


def test_running_total_over_day(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start.date(), start + dt.timedelta(seconds=20 * (i // 2)), i, Decimal(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "date date, ts timestamp_ntz, id int, amount decimal(18,2)")
    got = {r["id"]: r["used"] for r in running_total_over_day(df, "date", "ts", "id", "amount", "used").collect()}
    assert got == {i: Decimal(sum(range(i + 1))) for i in range(60)}


ACCOUNT = "account_id long, account_no string, product_id int, approvedon_date date"


def test_closing_balance_carries_over_days_without_movement(spark):
    accounts = spark.createDataFrame([(1, "1", 33, dt.date(2000, 1, 1)), (2, "2", 33, dt.date(2001, 1, 3))], ACCOUNT)
    txns = _txn(spark, [(1, 1, 1, 50, "2000-12-20"), (2, 1, 2, 50, "2001-01-02"), (3, 1, 1, 5, "2001-01-04"),
                        (4, 1, 1, 2, "2001-01-04"), (5, 2, 1, 9, "2001-01-04"), (6, 1, 1, 100, "2001-01-09")])
    got = {(r["account_id"], r["date"].day): r["closing_balance"]
           for r in ledger.closing_balance_daily(accounts, txns, "2001-01-01", "2001-01-05").collect()}
    one = [got[1, d] for d in range(1, 6)]
    assert one == [50, 0, 0, 7, 7]  # a true zero stays zero
    assert {d: got.get((2, d), "absent") for d in range(1, 6)} == {1: "absent", 2: "absent", 3: None, 4: 9, 5: 9}


def test_month_average_skips_unknown_days(spark):
    daily = spark.createDataFrame(
        [("a", dt.date(2001, 2, 27), None), ("a", dt.date(2001, 2, 28), Decimal(10)), ("a", dt.date(2001, 3, 1), Decimal(4))],
        "account_no string, date date, closing_balance decimal(18,2)",
    )
    got = {r["month"]: r["avg_balance"] for r in ledger.average_balance_by_month(ledger.as_intervals(daily)).collect()}
    assert got == {"2001-02": 10.0, "2001-03": 4.0}


def _random_ledger(spark, seed=9):
    rng = random.Random(seed)
    accounts = [(a, str(a), 33, dt.date(rng.choice([1999, 2000, 2001]), rng.randint(1, 12), 28)) for a in range(1, 13)]
    start = dt.date(1999, 1, 1)
    rows = [(i, rng.randint(1, 10), rng.choice([1, 2]), rng.randint(1, 90), str(start + dt.timedelta(days=rng.randrange(1000)))) for i in range(300)]
    return spark.createDataFrame(accounts, ACCOUNT), _txn(spark, rows)


def test_means_of_intervals_equal_means_of_days(spark):
    accounts, txns = _random_ledger(spark)
    span = ("2000-11-15", "2001-03-02")
    want = {}
    for r in ledger.closing_balance_daily(accounts, txns, *span).collect():
        if r["closing_balance"] is not None:
            want.setdefault((r["account_no"], f"{r['date']:%Y-%m}"), []).append(r["closing_balance"])
        else:
            want.setdefault((r["account_no"], f"{r['date']:%Y-%m}"), [])
    held = ledger.balance_intervals(accounts, txns, *span)
    got = {(r["account_no"], r["month"]): r["avg_balance"] for r in ledger.average_balance_by_month(held).collect()}
    assert set(got) == set(want)
    for key, days in want.items():
        assert got[key] == (None if not days else float(sum(days)) / len(days)) or abs(got[key] - float(sum(days)) / len(days)) < 1e-9
    plan = ledger.average_balance_by_month(held)._jdf.queryExecution().executedPlan().toString()
    assert "INTERVAL '1' DAY" not in plan and plan.count("Generate explode") == 1


def test_balances_since_a_day_equal_those_of_all_history(spark):
    _, txns = _random_ledger(spark)
    want = {r["transaction_id"]: r["running_balance"] for r in ledger.with_running_balance(txns).collect() if r["transaction_date"] >= dt.datetime(2000, 6, 1)}
    got = lambda df: {r["transaction_id"]: r["running_balance"] for r in df.collect()}
    assert got(ledger.with_running_balance_since(txns, "2000-06-01")) == want and want
    opening = ledger.stored_closing_balance(ledger.with_running_balance(txns), "2000-05-31")
    later = txns.filter("transaction_date >= timestamp_ntz '2000-06-01'")
    assert got(ledger.with_running_balance_since(later, "2000-06-01", opening)) == want


def test_backfill_from_a_snapshot_reads_the_years_since_it_alone(spark, tmp_path):
    accounts, txns = _random_ledger(spark)
    path = f"{tmp_path}/statements"
    sinks.write_by_year(txns.selectExpr("*", "year(transaction_date) as year"), path)
    statements = spark.read.parquet(path)
    balanced = ledger.with_running_balance(txns)
    snapshots = ledger.stored_closing_balance(balanced, "2000-12-20").unionByName(ledger.stored_closing_balance(balanced, "1999-06-30"))
    key = lambda r: (r["account_id"], r["date"])
    want = {key(r): r["closing_balance"] for r in ledger.closing_balance_daily(accounts, txns, "2001-01-05", "2001-02-20").collect()}
    found = ledger.closing_balance_backfill(accounts, statements, snapshots, "2001-01-05", "2001-02-20")
    assert {key(r): r["closing_balance"] for r in found.collect()} == want and want
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "year" in line.split("PartitionFilters")[1])
    folders = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "<= 2001" in folders and "year" in folders and "subquery" in folders.lower()
    none = snapshots.filter("false")
    assert {key(r): r["closing_balance"] for r in ledger.closing_balance_backfill(accounts, statements, none, "2001-01-05", "2001-02-20").collect()} == want


def test_month_end_of_a_leap_february(spark):
    daily = spark.createDataFrame(
        [("a", dt.date(2000, 2, d), Decimal(d)) for d in (28, 29)], "account_no string, date date, closing_balance decimal(18,2)"
    )
    got = ledger.monthly_balance_totals(daily).collect()
    assert [(r["date"].day, r["total_balance"], r["nonzero_accounts"]) for r in got] == [(29, 29, 1)]


def test_wide_balances_to_long(spark, rows):
    wide = spark.createDataFrame([("a", 1, 2), ("b", 3, None)], "account_no string, `2001_01_01` int, `2001_01_02` int")
    got = rows(ledger.wide_to_long_balances(wide))
    assert got == sorted([("a", dt.date(2001, 1, 1), 1), ("a", dt.date(2001, 1, 2), 2), ("b", dt.date(2001, 1, 1), 3),
                          ("b", dt.date(2001, 1, 2), None)], key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def test_gl_lines_are_one_per_counter_entry(spark):
    journal = spark.createDataFrame(
        [(1, 10, 3, 1, Decimal(5), dt.date(2001, 1, 1), 1), (2, 10, 4, 2, Decimal(5), dt.date(2001, 1, 1), 2),
         (3, 10, 3, 1, Decimal(7), dt.date(2001, 1, 1), 1), (4, 11, 5, 2, Decimal(9), dt.date(2001, 1, 1), 2)],
        "entry_id long, transaction_id long, gl_account_id int, type_enum int, amount decimal(18,2), entry_date date, "
        "classification_enum int",
    )
    gl = spark.createDataFrame([(3, "three"), (4, "four")], "gl_account_id int, gl_name string")
    got = ledger.gl_account_lines(journal, gl, 3, "2001-01-01").collect()
    assert [(r["entry_id"], r["credit_amount"], r["debit_amount"]) for r in got] == [(2, 5, 0)]


def test_a_day_booked_at_one_instant_is_summed_in_slices(spark):
    rows = [(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), i, Decimal(i % 7)) for i in range(500)]
    df = spark.createDataFrame(rows, "date date, ts timestamp, id long, amount decimal(18,2)")
    got = {r.id: r.used for r in running_total_over_day(df, "date", "ts", "id", "amount", "used", width=32).collect()}
    total, want = Decimal(0), {}
    for _, _, i, amount in rows:
        total += amount
        want[i] = total
    assert got == want


def test_ids_of_line_views_are_unique(spark):
    from coffer.plans.views import Bank

    bank = Bank(spark, "/root/testdata/sf0.001")
    for view in (bank.bill, bank.wallet_txn, bank.pos_txn):
        assert view.count() == view.select("transaction_id").distinct().count()
