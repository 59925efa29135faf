"""Every registered query: an operator bound to the test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coffer.functions import bands, dates, text
from coffer.functions.measures import total
from coffer.operators import bills, clients, clv, customer, joins, kpi, ledger, loans, marts, pos, quantiles, risk, staff, wallets
from coffer.plans.evidence import adoption_evidence
from coffer.plans.views import (
    APP_USER, AS_OF, CLIENT_AS_OF, CORPORATE, EVENT_AS_OF, EVENT_MART_AS_OF, FIXED_DEPOSIT, RETAIL_PRODUCTS, TABLES, Bank,
)
from coffer.session import ensure_checkpoint_dir, shared_dir
from coffer.sources import incremental, readers, sinks
from coffer.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

VOUCHER_CODES = ("VOUCHER|", "|429", "|133")
TEST_WALLETS = ("Supplier#000000001",)
TEST_SUBSCRIBERS = ("user-1",)
TERMINAL_MARK = "%supplier#%7%"
RELABELLED = ("/view", "/click")
DAILY_LIMIT = 10_000
# Widths of text columns of the staging tables.
SHORT_TEXT, LONG_TEXT = 256, 65_000
SMALL_QUOTA = 3
# Parameter points at which the model is checked.
PURCHASE_POINTS = np.array([(0.5, 8.0, 1.6, 2.5), (1.2, 20.0, 0.7, 3.0)])
SPEND_POINTS = np.array([(6.25, 3.74, 15.44), (2.0, 4.0, 90_000.0)])
ALERT_DAY = dt.date(1998, 7, 6)
HOLIDAYS = ("2024-01-01", "2024-01-26")


class Tables(Bank):
    """The bank, and the tables some operators make for others."""

    @cached_property
    def balanced(self) -> DataFrame:
        return ledger.with_running_balance(self.transaction)

    @cached_property
    def transfer(self) -> DataFrame:
        """A transfer per order: from its own transaction to the next one."""
        return self.table("orders").selectExpr(
            "o_orderkey as transfer_id", "o_orderkey as from_txn",
            "if(o_orderkey % 7 = 0, o_orderkey, o_orderkey + 1) as to_txn", "o_orderdate as transfer_date",
            "if(o_orderkey % 3 = 0, 'Deposit LIQUIDATION', 'Account transfer') as description",
        )

    @cached_property
    def groups(self) -> DataFrame:
        return self.table("nation").selectExpr("cast(9000000 + n_nationkey as bigint) as group_id", "n_name as group_name")

    @cached_property
    def grouped_account(self) -> DataFrame:
        """Accounts of which some belong to a group instead of a client."""
        return self.account.withColumn("client_id", F.expr("if(group_id is null, client_id, null)"))

    @cached_property
    def risk_score(self) -> DataFrame:
        """A rating between 0.5 and 5.0; clients of the segment FURNITURE have none."""
        return self.table("customer").filter("c_mktsegment <> 'FURNITURE'").selectExpr(
            "c_custkey as client_id", "cast((c_custkey % 10 + 1) / 2 as double) as risk_score"
        )

    @cached_property
    def staff(self) -> DataFrame:
        """Clients that referred somebody."""
        who = self.client.filter("referred_by_id is not null").selectExpr("referred_by_id as client_id")
        return self.client.join(who.distinct(), "client_id", "left_semi").selectExpr(
            "client_id as staff_id", "client_name as staff_name"
        )

    @cached_property
    def settlement(self) -> DataFrame:
        """Settlements exist for partner transactions."""
        return self.transaction.filter("partners <> 'INTERNAL'").selectExpr(
            "transaction_id", "channel as settled_channel", "response_code as settled_response"
        )

    @cached_property
    def wallet_accounts(self) -> DataFrame:
        return self.table("supplier").selectExpr("concat('10', lpad(cast(s_suppkey * 3 as string), 8, '0')) as account_no")

    @cached_property
    def earlier_limits(self) -> DataFrame:
        return self.client.selectExpr(
            "client_id",
            "cast(daily_withdraw_limit - if(client_id % 9 = 0, 10000, 0) as decimal(18,2)) as daily_withdraw_limit",
            "cast(max_transaction_limit - if(client_id % 14 = 0, 5000, 0) as decimal(18,2)) as max_transaction_limit",
        )

    @cached_property
    def calls(self) -> DataFrame:
        return marts.api_calls_kept(self.api_call, TEST_SUBSCRIBERS, RELABELLED)

    @cached_property
    def kept_wallet_txn(self) -> DataFrame:
        """Wallet rows without those of test wallets."""
        return wallets.without_parties(self.wallet_txn, self.wallet, "wallet_id", "wallet_name", TEST_WALLETS)

    @cached_property
    def terminal_wallet_txn(self) -> DataFrame:
        """Rows of the wallets whose name has the terminal mark."""
        return self.wallet_txn.join(self.wallet.filter(F.col("wallet_name").ilike(TERMINAL_MARK)), "wallet_id", "left_semi")


def present(df: DataFrame) -> DataFrame:
    """Result types that compare alike in both engines: money as double, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        REGISTRY[name] = build
        return build

    return register


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# -- loads and repairs -----------------------------------------------------------------------------------------------


def _loaded_events(t: Tables) -> DataFrame:
    """What an earlier run had loaded: the events before 20 January."""
    return t.table("events").filter(F.col("ts") < dates.day("2024-01-20"))


@query("incremental_high_water")
def _(t):
    return incremental.incremental_since(t.table("events"), _loaded_events(t), "event_id")


@query("incremental_high_water_default")
def _(t):
    empty = _loaded_events(t).filter(F.col("ts") < dates.day("2023-01-01"))
    return incremental.incremental_since_both(t.table("events"), empty, "event_id", "ts")


@query("incremental_two_marks")
def _(t):
    return incremental.incremental_since_both(t.table("events"), _loaded_events(t), "event_id", "ts")


@query("incremental_min_watermark")
def _(t):
    slower = t.table("events").filter(F.col("ts") < dates.day("2024-01-12"))
    return incremental.incremental_since_slower(t.table("events"), [_loaded_events(t), slower], "event_id")


@query("incremental_high_water_batch")
def _(t):
    """A pull of bounded size takes the lowest new keys."""
    return incremental.incremental_since(t.table("events"), _loaded_events(t), "event_id", limit=500)


@query("full_reload_snapshot")
def _(t):
    return t.loan.join(t.client.select("client_id", "client_name"), "client_id", "left").select(
        "loan_id", "client_id", "client_name", "principal_disbursed", "disbursedon_date", dates.day(AS_OF).alias("load_date")
    )


@query("id_range_batches")
def _(t):
    batches = incremental.id_ranges(t.transaction, "transaction_id", 100, 3000)
    return batches.groupBy("batch").agg(
        F.count(F.lit(1)).alias("rows"), F.min("transaction_id").alias("first_id"),
        F.max("transaction_id").alias("last_id"), F.sum("amount").alias("amount"),
    )


@query("statement_10min_slices")
def _(t):
    return incremental.time_slices(
        t.api_call, "date", 10, ["resource"], [F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount")]
    ).drop("slice_end")


@query("missing_keys_anti")
def _(t):
    target = t.pos_txn.filter(F.col("status_code") == "00").select(F.col("order_id").alias("o_orderkey"))
    return incremental.missing_keys(t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), target, "o_orderkey")


@query("dedupe_exact_rows")
def _(t):
    repeated = t.table("lineitem").unionByName(t.table("lineitem").filter("l_linenumber = 3"))
    return incremental.exact_row_repair(repeated)


@query("repeats_repaired_in_place")
def _(t):
    """A partitioned table in which some days were loaded twice; only their folders are written again."""
    path = _folder(t, "repair")
    events = t.table("events").withColumn("day", F.to_date("ts"))
    twice = events.filter(F.dayofmonth("day").isin(3, 17) & (F.col("event_id") % 5 == 0))
    sinks.write_per_party(events.unionByName(twice), path, "day")
    sinks.repair_in_place(t.spark, path, ["day"], ["event_id"], [F.col("ts")])
    return t.spark.read.parquet(path).select(*events.columns)


@query("reconcile_by_ranges")
def _(t):
    """Orders against what the terminals accepted, range by range of keys."""
    target = t.pos_txn.filter((F.col("status_code") == "00") | (F.col("order_id") > 4000)).select(F.col("order_id").alias("o_orderkey"))
    source = t.table("orders").select("o_orderkey").filter("o_orderkey % 1000 <> 7")
    return incremental.reconcile(source, target, "o_orderkey", width=512)


@query("duplicate_keys_report")
def _(t):
    return incremental.duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedupe_by_key")
def _(t):
    keys = ["l_orderkey", "l_linenumber"]
    lines = t.table("lineitem")
    order = [F.col(c).desc() for c in ("l_shipdate", *[c for c in lines.columns if c not in (*keys, "l_shipdate")])]
    return incremental.one_row_per_key(lines, keys, order)


@query("truncate_strings")
def _(t):
    return text.clip_beside(t.table("documents"), {"text": SHORT_TEXT})


@query("truncate_long_text")
def _(t):
    return text.clip_beside(t.table("documents"), {"text": LONG_TEXT})


@query("normalize_columns")
def _(t):
    shouted = t.table("customer").toDF("C_CustKey", "C_NAME", "C_NationKey", "C_AcctBal", "C_MktSegment")
    return incremental.normalize_columns(
        shouted, {"c_custkey": "client_id", "c_name": "client_name", "c_mktsegment": "client_category"},
        ["client_id", "client_name", "client_category"],
    )


# -- sinks, read back: these queries write when they are built ---------------------------------------------------------


@query("append_load")
def _(t):
    """Two loads into one table: what was there, then what is new."""
    path = _folder(t, "append_load")
    sinks.append_rows(_loaded_events(t), path)
    there = t.spark.read.schema(TABLES["events"]).parquet(path)
    sinks.append_rows(incremental.incremental_since(t.table("events"), there, "event_id"), path)
    return t.spark.read.schema(TABLES["events"]).parquet(path)


@query("saved_table")
def _(t):
    """A report saved as a table of the catalog and read by its name."""
    name = f"saved_{uuid.uuid4().hex}"
    sinks.save_table(t.account.groupBy("product_id", "product_name").agg(F.count(F.lit(1)).alias("accounts")), name)
    return t.spark.table(name)


@query("staged_tables")
def _(t):
    """Tables staged by name, one of them from where its target stopped; the rows of each."""
    root, loaded = _folder(t, "staged"), _loaded_events(t)
    sinks.append_rows(loaded, f"{root}/events")
    write = lambda df, name: (sinks.append_rows if name == "events" else sinks.overwrite_snapshot)(df, f"{root}/{name}")
    names = ["region", "nation", "customer", "events"]
    incremental.stage_tables(names, t.table, write, {"events": (loaded, "event_id")})
    counts = [t.spark.read.schema(TABLES[n]).parquet(f"{root}/{n}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
              for n in names]
    return reduce(DataFrame.unionByName, counts)


@query("csv_file")
def _(t):
    """A report written as CSV with a header, and read as a reference list."""
    path = _folder(t, "csv")
    signups = t.client.select("client_id", "client_name", "client_tier", "referred_by_id")
    sinks.write_csv(signups, path)
    return readers.read_csv_list(t.spark, path, signups.schema)


@query("reference_list_join")
def _(t):
    """Clients of a reference list that is kept as a file."""
    path = _folder(t, "list")
    sinks.write_csv(t.staff, path)
    staff_list = readers.read_csv_list(t.spark, path, t.staff.schema)
    return t.client.join(staff_list, F.col("referred_by_id") == F.col("staff_id")).select("client_id", "staff_id", "staff_name")


# -- codes, classes, text ----------------------------------------------------------------------------------------------


@query("decode_enum_labels")
def _(t):
    return clients.decode_client(t.client)


@query("client_category")
def _(t):
    wallet = t.table("supplier").select(F.col("s_suppkey").alias("client_id"))
    corporate = t.account.filter(F.col("product_id") == CORPORATE).select("client_id")
    return clients.client_category(t.client, wallet, corporate)


@query("account_type_classify")
def _(t):
    corporate = t.account.filter(F.col("product_id") == CORPORATE).select("account_no")
    app = t.client.filter(F.col("image_id").isNotNull()).select("client_id")
    return clients.account_type(t.account, t.wallet_accounts, corporate, app)


@query("generation_cohort")
def _(t):
    return customer.generation_counts(t.client)


@query("aml_risk_band")
def _(t):
    return t.client.select("client_id").join(t.risk_score, "client_id", "left").select(
        "client_id", "risk_score", bands.risk_band(F.col("risk_score")).alias("aml_risk_rating")
    )


@query("maturity_band")
def _(t):
    return t.account.filter(F.col("overdraft_end").isNotNull()).groupBy(
        bands.maturity_band(F.col("overdraft_end"), AS_OF).alias("band")
    ).agg(F.count(F.lit(1)).alias("accounts"), F.sum("overdraft_limit").alias("limit_total"))


@query("coalesce_valid_account")
def _(t):
    k = F.col("s_suppkey")
    first = F.when(k % 4 == 0, "0").when(k % 4 == 1, " ").when(k % 4 == 2, k.cast("string"))
    second = F.when(k % 5 == 0, "0").otherwise(F.concat(F.lit("20"), k.cast("string")))
    pairs = t.table("supplier").select("s_suppkey", first.alias("a"), second.alias("b"))
    return pairs.select("s_suppkey", bands.first_valid_account(F.col("a"), F.col("b")).alias("account_no"))


@query("large_txn_filter")
def _(t):
    return risk.large_transactions(t.transaction, 200_000).select(
        "transaction_id", "client_id", "amount", "product_id", "remarks", "transaction_date"
    )


@query("string_features")
def _(t):
    return t.table("customer").select(
        "c_custkey",
        F.left("c_name", F.lit(8)).alias("head"), F.right("c_name", F.lit(4)).alias("tail"),
        F.substring("c_name", 3, 5).alias("middle"), F.upper("c_name").alias("upper_name"),
        F.lower("c_mktsegment").alias("segment"), F.length("c_name").alias("name_length"),
        F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"),
        F.replace("c_name", F.lit("Customer#"), F.lit("C-")).alias("short_name"),
        F.concat(text.pan_head(F.lpad(F.col("c_custkey").cast("string"), 16, "5")), F.lit("******"),
                 text.pan_tail(F.lpad(F.col("c_custkey").cast("string"), 16, "5"))).alias("masked_pan"),
    )


@query("biller_categorise")
def _(t):
    return bills.with_biller(bills.with_code_text(t.branded_item)).groupBy("biller_by_rule").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("amount").alias("amount")
    )


@query("voucher_name_clean")
def _(t):
    return t.transaction.filter(F.col("third_party_name").isNotNull()).groupBy(
        text.strip_codes(F.col("third_party_name"), VOUCHER_CODES).alias("voucher")
    ).agg(F.count(F.lit(1)).alias("volume"))


@query("statement_id_head")
def _(t):
    rows = t.wallet_txn.filter(F.col("transaction_type") == "OUTFLOW").select(
        "transaction_id", "wallet_id", "statement_ids", "amount"
    )
    named = rows.join(t.wallet, "wallet_id", "left").drop("wallet_id")
    return ledger.statement_balance_by_head(named, t.transaction)


@query("explode_account_list")
def _(t):
    k = F.col("s_suppkey").cast("string")
    lists = t.table("supplier").select("s_name", F.concat(F.lit("[1"), k, F.lit(", 2"), k, F.lit(",3"), k, F.lit("]")).alias("accounts"))
    return text.explode_list_text(lists, "accounts", "account_no").select("s_name", "account_no")


@query("kpi_formatted")
def _(t):
    per_wallet = t.wallet_txn.groupBy("wallet_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v"))
    return per_wallet.join(t.wallet, "wallet_id", "left").select(
        "wallet_name", text.thousands(F.col("n")).alias("volume"), text.thousands(F.col("v"), 2, "N").alias("value"),
        text.percent_text(F.col("n") / 4, 2).alias("percent"),
    )


@query("calendar_spine")
def _(t):
    days = dates.calendar_spine(t.spark, "1995-01-01", AS_OF)
    active = t.transaction.groupBy(F.to_date("transaction_date").alias("date")).agg(F.count(F.lit(1)).alias("transactions"))
    return days.join(active, "date", "left").withColumn("transactions", F.coalesce("transactions", F.lit(0)))


@query("business_day_rollback")
def _(t):
    days = t.api_call.groupBy(F.to_date("date").alias("date")).agg(F.count(F.lit(1)).alias("calls"))
    spine = dates.with_previous_business_day(dates.date_spine(t.spark, "2023-12-20", EVENT_AS_OF), HOLIDAYS)
    return days.join(spine, "date")


# -- joins -------------------------------------------------------------------------------------------------------------


@query("pos_sweep_transfers")
def _(t):
    transit = t.account.filter(F.col("product_id") == CORPORATE).select("account_id")
    senders = t.transaction.join(transit, "account_id", "left_semi").select("transaction_id")
    sent = t.transfer.join(senders.select(F.col("transaction_id").alias("from_txn")), "from_txn", "left_semi")
    legs = ledger.balances_of(t.transaction, sent.select(F.explode(F.array("from_txn", "to_txn")).alias("transaction_id")))
    return pos.transfers_two_legs(t.transfer, legs, t.client, senders, "OWN BANK")


@query("transfer_two_legs")
def _(t):
    return pos.transfers_two_legs(t.transfer, t.balanced, t.client, t.transaction.select("transaction_id"), "OWN BANK")


@query("audit_user_accounts")
def _(t):
    k = F.col("o_orderkey")
    account_id = F.col("o_custkey") * 2 + k % 2
    audit = t.table("orders").select(
        k.alias("audit_id"), (k % 7).cast("int").alias("maker_id"),
        F.concat(F.lit("account=10"), F.lpad(account_id.cast("string"), 8, "0"), F.lit(";transit=10"),
                 F.lpad((account_id + 1).cast("string"), 8, "0")).alias("resource"),
    )
    return pos.audit_users(audit, t.staff_user, t.account, t.client, {"main": (9, 10), "transit": (28, 10)})


@query("transactions_enriched")
def _(t):
    return ledger.transactions_enriched(t.transaction, t.client, t.groups, t.grouped_account, t.settlement)


@query("bills_not_airtime")
def _(t):
    rest = incremental.missing_keys(t.bill_item, t.airtime, "transaction_id").groupBy("biller_id").agg(
        F.count(F.lit(1)).alias("bills"), F.sum("amount").alias("amount")
    )
    return rest.join(t.biller, "biller_id", "left").drop("biller_id")


@query("referrer_self_join")
def _(t):
    return staff.with_referrer(t.client)


@query("liquidation_or_join")
def _(t):
    legs = t.transaction.filter((F.col("product_id").isin(FIXED_DEPOSIT, 30)) & (F.col("type_enum") == 2)).select(
        F.col("transaction_id").alias("leg_id"), "product_name", "amount"
    )
    transfers = t.transfer.filter(F.col("description").ilike("%liq%"))
    return marts.either_end(transfers, legs, "from_txn", "to_txn", "leg_id")


@query("gl_entry_description")
def _(t):
    return ledger.gl_entry_descriptions(t.journal, t.gl_account, t.transaction, t.client)


def _commands(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    commands = t.table("orders").select(
        k.alias("command_id"), k.alias("resource_id"), (k % 6).cast("int").alias("maker_id"),
        (k % 8).cast("int").alias("checker_id"), (F.col("o_custkey") * 2).alias("account_id"),
        F.col("o_orderdate").alias("made_on"),
    )
    return commands


@query("call_over_lookup")
def _(t):
    return ledger.call_over(_commands(t), t.account, t.transaction, t.staff_user)


@query("call_over_of_day")
def _(t):
    return ledger.call_over(_commands(t), t.account, t.transaction, t.staff_user, "u.two", ALERT_DAY)


@query("client_or_group")
def _(t):
    return clients.client_or_group(t.grouped_account, t.client, t.groups)


@query("transactions_of_listed_keys")
def _(t):
    """Ledger rows of the orders that a terminal refused: neither side is small."""
    refused = t.pos_txn.filter((F.col("status_code") != "00") & (F.col("amount") > 30_000)).select(F.col("order_id").alias("l_orderkey"))
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.of_listed_keys(lines, refused, "l_orderkey")


@query("limit_increase")
def _(t):
    up = risk.limit_increases(t.client, t.earlier_limits)
    return risk.limit_increase_details(up, t.account, t.transaction, t.client)


@query("onboarding_crossdb")
def _(t):
    apps = t.table("events").filter(F.col("event_type") == "signup").select(
        F.col("event_id").alias("application_id"), F.col("user_id").alias("client_id"), F.col("ts").alias("created_on")
    )
    return clients.onboarding(apps, t.client, t.risk_score)


@query("left_join_on_filter")
def _(t):
    retail = t.account.filter(F.col("product_id").isin(*RETAIL_PRODUCTS) & F.col("closedon_date").isNull())
    held = retail.groupBy("client_id").agg(F.count(F.lit(1)).alias("open_retail_accounts"))
    return t.client.select("client_id", "daily_withdraw_limit").join(held, "client_id", "left")


# -- aggregates --------------------------------------------------------------------------------------------------------


@query("client_txn_summary")
def _(t):
    return customer.client_txn_summary(t.transaction)


@query("distinct_customers")
def _(t):
    return t.transaction.groupBy(F.coalesce("channel", F.lit("none")).alias("channel")).agg(
        F.countDistinct("client_id").alias("customers")
    )


@query("subaccount_last_txn")
def _(t):
    return staff.subaccount_last_txn(t.account, t.client, t.transaction, 33)


@query("avg_txn_per_customer")
def _(t):
    return t.transaction.groupBy("product_name").agg(*kpi.customers_and_mean("client_id"))


@query("gl_account_lines")
def _(t):
    return ledger.gl_account_lines(t.journal, t.gl_account, 3, "1996-08-05")


@query("gl_opening_balance")
def _(t):
    return ledger.gl_opening_balance(t.journal, t.gl_account, "2001-01-01")


@query("overdraft_collection_ratio")
def _(t):
    got = loans.collections(t.transaction, AS_OF)
    return got.join(t.account.select("account_id", "overdraft_limit"), "account_id").select(
        "account_id", "one_month_collection", "three_month_collection", "last_collection_date",
        F.round(F.col("three_month_collection").cast("double") / F.col("overdraft_limit").cast("double"), 6)
        .alias("three_month_ratio"),
    )


@query("overdraft_book_bounded")
def _(t):
    """The book from 90 days of credits and the last dates that were kept before them."""
    before = t.transaction.filter(F.col("transaction_date") < dates.day(AS_OF, -90))
    kept = loans.collections(before, AS_OF).select("account_id", "last_collection_date")
    return loans.overdraft_book(t.account, t.client, t.transaction, AS_OF, kept)


@query("limit_utilisation")
def _(t):
    paid = t.transaction.filter((F.col("partners") == "TRANSFER") & (F.col("response_code") == "00")).select(
        F.to_date("transaction_date").alias("date"), "amount"
    )
    return risk.limit_utilisation(paid, 90_000_000)


@query("expected_vs_actual_daily")
def _(t):
    return loans.expected_vs_actual_daily(t.schedule, t.payment)


@query("wallet_flow_totals")
def _(t):
    return wallets.flow_totals(t.kept_wallet_txn, t.wallet)


@query("clv_segment_stats")
def _(t):
    scored = quantiles.quantile_bins(clv.clv_inputs(_rfm(t)), "mean_value", ["D", "C", "B", "A"], "segment")
    return _rounded(customer.segment_statistics(scored, "segment", "monetary"), "std_value", digits=2)


# -- customer analytics ------------------------------------------------------------------------------------------------


def _rfm(t: Tables) -> DataFrame:
    return customer.rfm_base(t.client, t.transaction, AS_OF)


@query("rfm_base")
def _(t):
    return _rfm(t)


@query("rfm_base_per_account")
def _(t):
    return customer.rfm_base(t.client, t.transaction, AS_OF, ["HOUSEHOLD"], t.account, match_reference=True)


@query("rfm_quintiles")
def _(t):
    return _rounded(customer.rfm_quintiles(_rfm(t)), "recency", "frequency", "monetary", digits=4)


@query("rfm_scores")
def _(t):
    return customer.rfm_scores(_rfm(t))


@query("rfm_segments")
def _(t):
    return customer.rfm_segments(_rfm(t))


@query("rfm_segment_counts")
def _(t):
    return customer.segment_counts(customer.rfm_segments(_rfm(t)))


@query("active_dormancy")
def _(t):
    """Balances are rebuilt for the twelve months alone, from one opening sum per account."""
    recent = ledger.with_running_balance_since(t.transaction, dates.years_back(AS_OF, 12))
    return customer.active_dormancy(t.client, recent, AS_OF)


@query("client_demographics")
def _(t):
    identity = t.client.select("client_id", bands.decode("gender_code", bands.CLIENT_GENDER).alias("gender"))
    return customer.client_demographics(t.client, identity, t.state, AS_OF)


@query("product_channel_adoption")
def _(t):
    return customer.adoption_matrix(t.client, adoption_evidence(t), AS_OF)


@query("clv_inputs")
def _(t):
    return clv.clv_inputs(_rfm(t))


@query("clv_gamma_gamma_score")
def _(t):
    scored = clv.gamma_gamma_mean(clv.clv_inputs(_rfm(t)), clv.GammaGammaParams(p=6.25, q=3.74, v=15.44))
    return _rounded(scored.select("client_id", "frequency", "expected_value"), "expected_value", digits=4)


@query("clv_quartile_segment")
def _(t):
    scored = quantiles.quantile_bins(clv.clv_inputs(_rfm(t)), "mean_value", ["D", "C", "B", "A"], "segment")
    return scored.select("client_id", "mean_value", "segment")


# -- ledger and reports ------------------------------------------------------------------------------------------------


@query("running_balance")
def _(t):
    return t.balanced.select("transaction_id", "account_id", "amount", "running_balance")


@query("latest_running_balance")
def _(t):
    return ledger.latest_running_balance(t.transaction)


@query("closing_balance_stored")
def _(t):
    return ledger.stored_closing_balance(t.balanced, AS_OF)


@query("closing_balance_carried")
def _(t):
    """Yesterday's table and today's rows give what the full history gives."""
    yesterday = ledger.stored_closing_balance(t.balanced, AS_OF - dt.timedelta(days=1))
    return ledger.closing_balance_carried(yesterday, t.transaction, AS_OF)


@query("closing_balance_daily")
def _(t):
    return ledger.closing_balance_daily(t.account, t.transaction, "2001-07-01", "2001-07-31")


@query("closing_balance_backfill")
def _(t):
    """Many days from a stored snapshot and the statements in their yearly folders; an older snapshot is not used."""
    folder = _folder(t, "statements")
    sinks.write_by_year(t.transaction.withColumn("year", F.year("transaction_date")), folder)
    statements = t.spark.read.parquet(folder)
    snapshots = ledger.stored_closing_balance(t.balanced, "2001-05-31").unionByName(
        ledger.stored_closing_balance(t.balanced, "1995-12-31")
    )
    return ledger.closing_balance_backfill(t.account, statements, snapshots, "2001-07-01", "2001-07-31")


@query("avg_balance_by_month")
def _(t):
    held = ledger.balance_intervals(t.account, t.transaction, "2001-05-01", "2001-07-31")
    return ledger.average_balance_by_month(held)


@query("monthly_balance_totals")
def _(t):
    return ledger.monthly_balance_totals(_month_ends(t))


def _month_ends(t: Tables) -> DataFrame:
    return ledger.closing_balance_monthly(t.account, t.transaction, "2001-01-01", "2001-07-31")


@query("closing_balance_monthly")
def _(t):
    return _month_ends(t)


@query("staff_balance_pivot")
def _(t):
    owned = ledger.closing_balance_monthly(t.account, t.transaction, "2001-01-01", "2001-07-31", ["client_id"])
    return staff.staff_balance_pivot(owned, t.client, [f"2001-{m:02d}" for m in range(1, 8)])


@query("avg_balance_wide")
def _(t):
    held = ledger.balance_intervals(t.account, t.transaction, "2001-05-01", "2001-07-31")
    return ledger.average_balance_wide(held, ["account_no"], ["2001-05", "2001-06", "2001-07"])


@query("balances_wide_to_long")
def _(t):
    days = [dt.date(2001, 7, 25) + dt.timedelta(days=i) for i in range(7)]
    daily = ledger.closing_balance_daily(t.account, t.transaction, days[0], days[-1])
    return ledger.wide_to_long_balances(ledger.long_to_wide_balances(daily, "account_no", days))


@query("bank_statement_lines")
def _(t):
    return ledger.statement_lines(t.balanced)


@query("reversal_lines")
def _(t):
    return ledger.reversal_lines(t.transaction)


@query("statement_with_reference")
def _(t):
    return ledger.statement_with_reference(ledger.statement_lines(t.balanced), t.wallet_txn).select(
        "transaction_id", "session_id", "debit", "credit", "transaction_reference"
    )


@query("negative_balance_summary")
def _(t):
    return ledger.negative_balance_summary(t.account)


@query("negative_balance_accounts")
def _(t):
    return ledger.negative_balance_accounts(t.transaction, t.account, t.client, AS_OF)


@query("wallet_statement_all")
def _(t):
    return wallets.wallet_statement(t.wallet_txn, t.bank, t.wallet)


@query("pooled_multi_leg")
def _(t):
    return wallets.pooled_multi_leg(t.wallet_txn.withColumn("transaction_id", F.col("pooled_id")), t.wallet)


@query("wallet_intra_inter")
def _(t):
    return wallets.intra_inter_by_wallet(t.kept_wallet_txn, t.wallet)


@query("top_transfer_wallets")
def _(t):
    return wallets.top_wallets(t.kept_wallet_txn, t.wallet)


@query("api_calls_by_resource")
def _(t):
    return wallets.calls_by(t.calls, "resource_consumed")


@query("api_calls_by_client")
def _(t):
    return wallets.calls_by(t.calls, "subscriber", "resource_consumed")


@query("top_api_clients")
def _(t):
    return wallets.top_clients(t.calls)


@query("weekly_kpi_unpivot")
def _(t):
    groups = {"lookup": ("/view", "/view-account"), "click": ("/click", "/click-account"), "sale": ("/purchase",)}
    week = t.calls.filter(dates.last_days(F.col("date"), EVENT_AS_OF, 7))
    flows = wallets.accepted_flows(t.kept_wallet_txn).filter(dates.last_days(F.col("time"), AS_OF, 7))
    return wallets.weekly_kpis(week, flows, groups, _mean_deposits(t))


@query("kpi_unpivot")
def _(t):
    one = t.transaction.agg(
        F.count(F.lit(1)).alias("transactions"), total("amount").alias("amount"), F.countDistinct("client_id").alias("clients")
    )
    return wallets.kpi_rows(one)


@query("mean_deposit_last_week")
def _(t):
    return _mean_deposits(t)


def _mean_deposits(t: Tables) -> DataFrame:
    held = ledger.balance_intervals(t.account, t.transaction, "2001-07-26", "2001-08-01")
    return wallets.mean_deposit_last_week(held, t.wallet_accounts, AS_OF)


@query("tier_large_txn_alert")
def _(t):
    return risk.tier_alerts(t.transaction, t.client)


@query("tier_alerts_of_day")
def _(t):
    return risk.tier_alerts(t.balanced, t.client, on=ALERT_DAY)


@query("repeat_txn_clients")
def _(t):
    monthly = risk.tier_alerts(t.transaction, t.client).withColumn("transaction_date", F.trunc("transaction_date", "month"))
    return risk.repeat_alerts(monthly).select("transaction_id", "client_id", "transaction_type", "alert_date", "hits", "amount")


@query("manual_accounts_opened")
def _(t):
    return risk.manual_accounts_opened(t.account, t.client, t.risk_score, APP_USER, (24, 26, 29, 33, 212))


@query("new_account_compliance")
def _(t):
    a = F.col("account_id")
    blocks = t.account.filter(F.col("balance") < 0).select(
        "account_id",
        F.when(a % 3 == 0, "BLOCK DEBIT").when(a % 3 == 1, "BLOCK CREDIT").otherwise("NOTE").alias("sub_status"),
        F.concat(F.lit("note "), (a % 10).cast("string")).alias("note"),
        F.date_add("approvedon_date", 30).alias("created_date"),
    )
    return risk.new_account_compliance(t.account, t.client, t.risk_score, blocks, dt.date(1994, 3, 15), RETAIL_PRODUCTS)


@query("overdraft_book")
def _(t):
    return loans.overdraft_book(t.account, t.client, t.transaction, AS_OF)


@query("overdrafts_granted")
def _(t):
    return loans.overdrafts_granted(t.account, t.client, AS_OF - dt.timedelta(days=60))


@query("pos_transactions")
def _(t):
    return pos.pos_transactions(t.pos_txn, t.account, t.client, "POSV")


@query("pos_failed_three_months")
def _(t):
    recent = t.pos_txn.filter(F.col("transaction_date") >= F.lit(dates.years_back(AS_OF, 3)))
    return pos.pos_transactions(recent, t.account, t.client, "POSV", accepted=False)


@query("pos_terminals")
def _(t):
    return pos.pos_terminals(t.pos_txn, t.account, t.client)


@query("term_deposit_maturity")
def _(t):
    return loans.term_deposit_maturity(t.term_deposit, AS_OF)


@query("deposits_expected_vs_actual")
def _(t):
    return loans.deposits_expected_vs_actual(t.term_deposit)


@query("fresh_vs_rollover")
def _(t):
    return loans.fresh_or_rollover(t.transaction, FIXED_DEPOSIT, (APP_USER,), t.account)


@query("loan_star_enrich")
def _(t):
    return loans.loan_details(t.loan, t.code_value, t.staff_user, t.client)


@query("schedule_enriched")
def _(t):
    return loans.schedule_enriched(t.schedule.drop("flag"), t.loan)


@query("staff_loan_attribution")
def _(t):
    return loans.staff_attribution(t.loan, t.client)


@query("loans_disbursed_month")
def _(t):
    return loans.loans_disbursed_last_month(t.loan, t.client, AS_OF)


@query("partner_loans_yesterday")
def _(t):
    return loans.partner_loans_yesterday(t.loan, (1, 2, 3), dt.date(2001, 7, 25))


@query("open_or_closed_this_year")
def _(t):
    return loans.open_or_closed_this_year(t.loan, ["loan_id", "client_id", "disbursedon_date", "closedon_date"], AS_OF)


@query("accounts_open_or_closed_this_year")
def _(t):
    return loans.open_or_closed_this_year(
        t.account, ["account_id", "client_id", "product_name", "approvedon_date", "closedon_date"], AS_OF
    )


@query("staff_loans")
def _(t):
    return loans.staff_loans(t.loan, t.client)


@query("downline_split")
def _(t):
    return staff.downlines(t.account, t.client, t.loan)


@query("deposit_drive")
def _(t):
    return staff.deposit_drive(t.transaction, t.client, t.staff, FIXED_DEPOSIT, "2001-07-01", AS_OF)


@query("deposit_drive_pivot")
def _(t):
    days = [dt.date(2001, 7, 23) + dt.timedelta(days=i) for i in range(5)]
    return staff.deposit_drive_pivot(t.transaction, t.client, days, FIXED_DEPOSIT)


@query("staff_month_pivot")
def _(t):
    return staff.staff_month_pivot(t.loan, t.client, 2001, range(1, 7))


@query("corporate_accounts_opened")
def _(t):
    return staff.corporate_accounts_opened(t.account, t.client, CORPORATE, "1994-03-01", "1994-04-01")


@query("signups_last_month")
def _(t):
    return staff.signups_last_month(t.client, CLIENT_AS_OF)


@query("airtime_transactions")
def _(t):
    return bills.airtime_transactions(t.branded_item)


@query("bills_transactions")
def _(t):
    return bills.bills_transactions(t.branded_item)


@query("airtime_by_brand")
def _(t):
    return bills.airtime_transactions(t.branded_item).groupBy("brand").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("amount").alias("amount")
    )


@query("bills_by_rule")
def _(t):
    return bills.bills_transactions(t.branded_item).groupBy("biller_by_rule").agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("amount").alias("amount")
    )


@query("unmapped_biller_codes")
def _(t):
    coded = t.bill_item.withColumn("biller_code", F.concat_ws(" ", "biller_code", F.col("biller_id").cast("string")))
    return bills.unmapped_codes(coded, coded.filter(F.col("transaction_date") < dates.day("2001-01-01")))


@query("card_requests")
def _(t):
    requests = t.card.select("card_id", "client_id", "account_id")
    charges = t.card.filter(F.col("charge").isNotNull()).select("card_id", "charge")
    return pos.card_requests(requests, charges, t.grouped_account, t.groups)


@query("card_transactions")
def _(t):
    loaded = t.card_txn.filter(F.col("transaction_date") < dates.day("1995-01-10"))
    fresh = incremental.incremental_since(t.card_txn, loaded, "id").withColumn("account_id", F.expr("client_id * 2"))
    return pos.card_transactions(fresh, clients.client_or_group(t.grouped_account, t.client, t.groups))


@query("terminal_wallet_load")
def _(t):
    loaded = t.terminal_wallet_txn.filter("transaction_type = 'INITIAL INFLOW'").filter(F.col("time") < dates.day("1995-06-01"))
    fresh = incremental.incremental_since(t.terminal_wallet_txn, loaded, "transaction_id")
    held = t.client.selectExpr("client_id", "concat('20', lpad(cast(client_id as string), 8, '0')) as account_no")
    return pos.terminal_wallet_load(fresh, t.bank, held, t.client)


@query("card_type_by_charge")
def _(t):
    return t.card.groupBy(bands.card_type_by_charge(F.col("charge")).alias("card_type")).agg(F.count(F.lit(1)).alias("cards"))


@query("cards_produced")
def _(t):
    return pos.cards_produced(t.card, t.client)


@query("cards_expiring_year")
def _(t):
    return marts.cards_to_expire(t.card, CLIENT_AS_OF)


@query("client_master")
def _(t):
    corporate = t.account.filter(F.col("product_id") == CORPORATE).select("client_id")
    wallet = t.table("supplier").select(F.col("s_suppkey").alias("client_id"))
    category = clients.client_category(t.client, wallet, corporate)
    registry = t.account.select("client_id", F.concat(F.lit("RC"), F.col("account_id").cast("string")).alias("registry_no"))
    return clients.client_master(t.client, t.state, category, registry)


@query("group_clients")
def _(t):
    members = t.account.filter(F.col("group_id").isNotNull()).select("group_id", "client_id")
    return clients.group_clients(t.groups, members)


@query("account_master")
def _(t):
    return clients.account_master(t.grouped_account, t.product, t.client, t.groups)


@query("wallet_bills_week")
def _(t):
    return wallets.bills_of_week(t.bill, t.biller, AS_OF).select("transaction_id", "biller", "amount", "transaction_date")


# -- marts -------------------------------------------------------------------------------------------------------------

MARTS = {
    **marts.retail_marts(CLIENT_AS_OF, RETAIL_PRODUCTS, (24, 30, 33), APP_USER),
    **marts.payment_marts(AS_OF, FIXED_DEPOSIT, (FIXED_DEPOSIT, 30), CORPORATE, VOUCHER_CODES),
    **marts.wallet_marts(AS_OF),
    **marts.api_marts(EVENT_MART_AS_OF, TEST_SUBSCRIBERS, RELABELLED),
}


BILLER_MARTS = ("bills", "airtime")


def _register_marts() -> None:
    for name, mart, grain in kpi.mart_names(MARTS):
        if mart in BILLER_MARTS:  # counted by id, named after
            REGISTRY[name] = lambda t, mart=mart, grain=grain: (
                MARTS[mart].build(t, grain).join(t.biller, "biller_id", "left").drop("biller_id")
            )
        else:
            REGISTRY[name] = lambda t, mart=mart, grain=grain: MARTS[mart].build(t, grain)
    success = lambda df: df.filter(F.col("transaction_status") == "success")
    for grain, suffix in (("monthly", "monthly"), ("ytd", "daily")):
        REGISTRY[f"top_biller_{suffix}"] = lambda t, g=grain: kpi.top_by_period(
            success(t.bill_only), "transaction_date", g, "biller_id", AS_OF, "biller_count"
        ).join(t.biller, "biller_id").drop("biller_id")
        REGISTRY[f"top_airtime_{suffix}"] = lambda t, g=grain: kpi.top_by_period(
            success(t.airtime), "transaction_date", g, "biller_id", AS_OF, "biller_count"
        ).join(t.biller, "biller_id").drop("biller_id")
        REGISTRY[f"free_vs_extra_quota_{suffix}"] = lambda t, g=grain: kpi.quota_by_period(
            marts.free_quota_transfers(t.transaction), "transaction_date", g, "client_id", marts.FREE_TRANSFERS, AS_OF,
        )


_register_marts()

# Inventory names of single building blocks, and the marts that show them.
BLOCKS = {
    "channel_volume_value_monthly": "mart_intrabank_monthly",
    "channel_volume_value_ytd": "mart_intrabank_ytd",
    "tier_counts_monthly": "mart_retail_tier_monthly",
    "card_status_monthly": "mart_card_status_monthly",
    "card_type_monthly": "mart_cards_monthly",
    "success_fail_monthly": "mart_pos_monthly",
    "fd_value_corporate": "mart_fd_corporate_monthly",
    "fd_value_retail": "mart_fd_retail_monthly",
}
REGISTRY.update({block: REGISTRY[mart] for block, mart in BLOCKS.items()})


@query("free_vs_extra_quota")
def _(t):
    """With a quota that clients of the test data pass: all accepted outward movements count."""
    transfers = t.transaction.filter((F.col("type_enum") == 2) & (F.col("response_code") == "00"))
    return kpi.quota_by_period(transfers, "transaction_date", "monthly", "client_id", 1, AS_OF)


@query("free_vs_extra_quota_ytd")
def _(t):
    transfers = t.transaction.filter((F.col("type_enum") == 2) & (F.col("response_code") == "00"))
    return kpi.quota_by_period(transfers, "transaction_date", "ytd", "channel", SMALL_QUOTA, AS_OF)


@query("mart_gender_totals")
def _(t):
    return marts.gender_totals(t.client)


@query("mart_bill_buyers")
def _(t):
    return marts.distinct_buyers(t.bill_only.select("order_id"), t.order_owner, "order_id", "purchase_bill_customers")


@query("mart_airtime_buyers")
def _(t):
    return marts.distinct_buyers(t.airtime.select("order_id"), t.order_owner, "order_id", "purchase_airtime_customers")


@query("loan_daily_spine")
def _(t):
    return marts.loan_daily_spine(t.loan, t.schedule, t.payment, "2000-01-01", AS_OF)


# -- alerts that also run as streams -----------------------------------------------------------------------------------


@query("limit_band_alerts")
def _(t):
    events = t.api_call.select(F.to_date("date").alias("date"), F.col("date").alias("ts"), "id", "amount")
    return risk.limit_band_alerts(events, DAILY_LIMIT)


@query("settlement_position")
def _(t):
    calls = t.api_call.select(F.col("date").alias("ts"), "amount", "resource")
    outward = calls.filter(F.col("resource") == "/purchase")
    inward = calls.filter(F.col("resource") == "/signup")
    return risk.settlement_position(outward, inward, dt.datetime(2024, 1, 29, 10, 30), 20_000, holidays=HOLIDAYS)


@query("settlement_text")
def _(t):
    calls = t.api_call.select(F.col("date").alias("ts"), "amount", "resource")
    position = risk.settlement_position(
        calls.filter(F.col("resource") == "/purchase"), calls.filter(F.col("resource") == "/signup"),
        dt.datetime(2024, 1, 29, 10, 30), 20_000, holidays=HOLIDAYS,
    )
    return risk.settlement_text(position)


# -- streams, run to the end of their input ----------------------------------------------------------------------------


def _event_stream(t: Tables) -> DataFrame:
    events = jobs.read_files(t.spark, t.sf_dir, TABLES["events"], names="events.parquet")
    return events.selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "user_id", "event_type", "cast(value as decimal(18,2)) as amount"
    )


def _folder(t: Tables, name: str) -> str:
    """A new folder of the shared folder. These queries run their stream when they are built."""
    return f"{shared_dir(t.spark, name)}/{uuid.uuid4().hex}"


def _kept_up(t: Tables, name: str, stream: DataFrame, keys: list[str]) -> DataFrame:
    folder = _folder(t, name)
    jobs.run_updates(stream, f"{folder}/rows", f"{folder}/state")
    return jobs.latest(t.spark, f"{folder}/rows", stream.schema, keys)


@query("stream_incremental_append")
def _(t):
    folder, stream = _folder(t, "append"), _event_stream(t)
    jobs.run_append(stream, f"{folder}/rows", f"{folder}/state", "event_id", repeats_within="1 hour")
    return jobs.appended(t.spark, f"{folder}/rows", stream.schema)


@query("stream_tumbling_10min")
def _(t):
    measures = [F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount")]
    slices = jobs.tumbling_slices(_event_stream(t), "ts", ["event_type"], measures)
    return _kept_up(t, "slices", slices, ["slice_start", "event_type"])


@query("stream_limit_band_alerts")
def _(t):
    folder = _folder(t, "bands")
    events = _event_stream(t).select(F.to_date("ts").alias("date"), "ts", F.col("event_id").alias("id"), "amount")
    jobs.run_band_alerts(events, folder, f"{folder}/state", DAILY_LIMIT)
    return jobs.band_alerts(t.spark, folder)


@query("stream_settlement_cycles")
def _(t):
    sided = _event_stream(t).filter("event_type in ('purchase', 'signup')").selectExpr(
        "ts", "amount", "if(event_type = 'purchase', 'out', 'in') as side"
    )
    calendar = dates.date_spine(t.spark, "2023-12-01", EVENT_MART_AS_OF)
    return _kept_up(t, "cycles", jobs.cycle_totals(jobs.with_cycle(sided, "ts", calendar, holidays=HOLIDAYS)), ["cycle_start"])


# -- lifetime value model ----------------------------------------------------------------------------------------------


def _kept_inputs(t: Tables) -> DataFrame:
    """The model's inputs, computed once for the fits, the scores and the quartiles."""
    ensure_checkpoint_dir(t.spark)
    return clv.model_inputs(_rfm(t)).checkpoint()


@query("clv_bgnbd_fit")
def _(t):
    p = clv.fit_purchases(clv.model_inputs(_rfm(t)))
    return t.spark.range(1).select(
        *[F.round(F.lit(v), 3).alias(k) for k, v in (("r", p.r), ("alpha", p.alpha), ("a", p.a), ("b", p.b))]
    )


@query("clv_gamma_gamma_fit")
def _(t):
    p = clv.fit_spend(clv.model_inputs(_rfm(t)))
    return t.spark.range(1).select(*[F.round(F.lit(v), 3).alias(k) for k, v in (("p", p.p), ("q", p.q), ("v", p.v))])


@query("clv_purchase_loglik")
def _(t):
    counted = clv.model_inputs(_rfm(t)).groupBy("x", "t_x", "age").agg(F.count(F.lit(1)).alias("n"))
    totals = clv.loglik_totals(counted, ["x", "t_x", "age"], clv.purchase_loglik, PURCHASE_POINTS)
    return _rounded(totals, "total", digits=3)


@query("clv_spend_loglik")
def _(t):
    inputs = clv.model_inputs(_rfm(t)).filter("x > 0")
    counted = inputs.groupBy("x", "mean_value").agg(F.count(F.lit(1)).alias("n"))
    return _rounded(clv.loglik_totals(counted, ["x", "mean_value"], clv.spend_loglik, SPEND_POINTS), "total", digits=3)


@query("clv_value_at_point")
def _(t):
    """Expected purchases, spend and value at stated parameters, for every client."""
    scored = clv.lifetime_value(clv.model_inputs(_rfm(t)), clv.PurchaseParams(*PURCHASE_POINTS[0]), clv.GammaGammaParams(*SPEND_POINTS[0]))
    scored = scored.select("client_id", "x", "expected_12_weeks", "expected_24_weeks", "expected_value", "clv")
    return _rounded(_rounded(scored, "expected_12_weeks", "expected_24_weeks", digits=6), "expected_value", "clv", digits=3)


@query("clv_expected_purchases")
def _(t):
    inputs = _kept_inputs(t)
    scored = clv.with_expected_purchases(inputs, clv.fit_purchases(inputs), clv.HORIZON_WEEKS)
    return scored.select(
        "client_id", "x", F.round(F.col("expected")[0], 4).alias("expected_12_weeks"),
        F.round(F.col("expected")[1], 4).alias("expected_24_weeks"),
    )


@query("clv_value")
def _(t):
    inputs = _kept_inputs(t)
    spend = clv.fit_spend(inputs, stable=True)
    scored = clv.value_segments(clv.lifetime_value(inputs, clv.fit_purchases(inputs), spend))
    return _rounded(scored, "expected_12_weeks", "expected_24_weeks", "expected_value", "clv", digits=2)


def queries() -> dict[str, Query]:
    """Name -> callable(spark, sf_dir)."""

    def bind(build: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: present(build(Tables(spark, sf_dir)))

    return {name: bind(build) for name, build in REGISTRY.items()}
