"""Loans, overdrafts and term deposits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions import bands
from coffer.functions.dates import DateLike, as_date, day, last_full_month, yesterday
from coffer.functions.measures import percent_of, sum_when
from coffer.functions.text import percent_text
from coffer.operators.joins import left_join_known, referrers


def lookup_codes(df: DataFrame, codes: DataFrame, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Labels of several code columns from one code table.

    ``wanted`` maps the new column to (code name, code column). Spark sends a code table of a few hundred rows to all
    tasks by its own size check, and the same scan serves every join.
    """
    for label, (code_name, column) in wanted.items():
        side = codes.filter(F.col("code_name") == code_name).select(
            F.col("code_id").alias(column), F.col("label").alias(label)
        )
        df = df.join(side, column, "left")
    return df


def lookup_users(df: DataFrame, users: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """User names of several id columns from one user table; ``wanted`` maps new column to id column."""
    for name, column in wanted.items():
        df = df.join(users.select(F.col("user_id").alias(column), F.col("username").alias(name)), column, "left")
    return df


def loan_details(loans: DataFrame, codes: DataFrame, users: DataFrame, clients: DataFrame) -> DataFrame:
    """Loans with all codes and users named, and the client."""
    named = lookup_codes(
        loans, codes,
        {"loan_status": ("status", "loan_status_id"), "purpose": ("purpose", "purpose_id"),
         "collateral": ("collateral", "collateral_id"), "loan_product": ("product", "product_id")},
    )
    named = lookup_users(named, users, {"officer": "officer_id", "approver": "approver_id"})
    return named.join(clients.select("client_id", "client_name"), "client_id", "left").select(
        "loan_id", "client_id", "client_name", "loan_status", "purpose", "collateral", "loan_product", "officer",
        "approver", "principal_disbursed", "interest_charged", "total_expected_repayment",
    )


def schedule_enriched(schedule: DataFrame, loans: DataFrame) -> DataFrame:
    """Instalments with their loan's client and status."""
    return schedule.join(loans.select("loan_id", "client_id", "loan_status_id"), "loan_id", "left")


def expected_vs_actual_daily(schedule: DataFrame, payments: DataFrame) -> DataFrame:
    """Per due day: amount due, amount paid on that day (0 where none)."""
    due = schedule.groupBy(F.col("duedate").alias("date")).agg(
        F.sum(F.col("principal_amount") + F.col("interest_amount")).alias("expected")
    )
    paid = payments.groupBy(F.col("transaction_date").alias("date")).agg(F.sum("amount").alias("actual"))
    return due.join(paid, "date", "left").withColumn("actual", F.coalesce("actual", F.lit(0).cast("decimal(28,2)")))


def staff_attribution(loans: DataFrame, clients: DataFrame) -> DataFrame:
    """Loans and principal per referrer of the client. Summed per client first, then per referrer, then named."""
    per_client = loans.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("principal_disbursed").alias("principal")
    )
    per_referrer = (
        per_client.join(clients.select("client_id", "referred_by_id"), "client_id")
        .filter(F.col("referred_by_id").isNotNull())
        .groupBy("referred_by_id")
        .agg(F.sum("loans").alias("loans"), F.sum("principal").alias("principal"))
    )
    staff = clients.select(F.col("client_id").alias("referred_by_id"), F.col("client_name").alias("staff_name"))
    return per_referrer.join(staff, "referred_by_id", "left").select("referred_by_id", "staff_name", "loans", "principal")


def staff_loans(loans: DataFrame, clients: DataFrame) -> DataFrame:
    """Loans of referred clients with the referrer's name."""
    staff = clients.select(F.col("client_id").alias("referred_by_id"), F.col("client_name").alias("staff_name"))
    referred = clients.filter(F.col("referred_by_id").isNotNull()).select("client_id", "referred_by_id").join(
        staff, "referred_by_id"
    )
    return loans.join(referred, "client_id").select(
        "loan_id", "client_id", "principal_disbursed", "disbursedon_date", "referred_by_id", "staff_name"
    )


def loans_disbursed_last_month(loans: DataFrame, clients: DataFrame, as_of: DateLike) -> DataFrame:
    return (
        loans.filter(last_full_month(F.col("disbursedon_date"), as_of))
        .join(clients.select("client_id", "client_name", "client_tier"), "client_id", "left")
        .select("loan_id", "client_id", "client_name", "client_tier", "principal_disbursed", "disbursedon_date")
    )


def partner_loans_yesterday(loans: DataFrame, product_ids: Sequence[int], as_of: DateLike) -> DataFrame:
    """Loans of the partner products disbursed the day before ``as_of``."""
    return loans.filter(F.col("product_id").isin(*product_ids) & yesterday(F.col("disbursedon_date"), as_of)).select(
        "loan_id", "client_id", "product_id", "principal_disbursed", "total_expected_repayment"
    )


def open_or_closed_this_year(items: DataFrame, columns: Sequence[str], as_of: DateLike) -> DataFrame:
    """Loans or accounts still open, or closed in the year of ``as_of``: one pass for what a union of two reads gives."""
    year_start = F.lit(as_date(as_of).replace(month=1, day=1))
    kept = items.filter(F.col("closedon_date").isNull() | (F.col("closedon_date") >= year_start))
    return kept.select(*columns).distinct()


def collections(txns: DataFrame, as_of: DateLike, last_known: DataFrame | None = None) -> DataFrame:
    """Credits of each account in the last 30 and 90 days, and the last credit, in one pass.

    With ``last_known`` (account_id, last_collection_date), the table that an earlier run kept, only 90 days are read: the bound
    is a filter on the scan, and an account that had no credit since has the date of the kept table.
    """
    ts = F.col("transaction_date")
    recent = lambda days: (ts >= day(as_of, -days)) & (ts < day(as_of, 1))
    credits_ = txns.filter((F.col("type_enum") == 1) & (F.col("is_reversed") == "No")).select("account_id", "transaction_date", "amount")
    if last_known is not None:
        kept = last_known.select(
            "account_id", F.col("last_collection_date").cast(credits_.schema["transaction_date"].dataType).alias("transaction_date"),
            F.lit(None).cast(credits_.schema["amount"].dataType).alias("amount"),
        )
        credits_ = credits_.filter(ts >= day(as_of, -90)).unionByName(kept)
    return credits_.groupBy("account_id").agg(
        sum_when(recent(30), "amount").alias("one_month_collection"),
        sum_when(recent(90), "amount").alias("three_month_collection"),
        F.max("transaction_date").cast("date").alias("last_collection_date"),
    )


def overdraft_book(
    accounts: DataFrame, clients: DataFrame, txns: DataFrame, as_of: DateLike, last_known: DataFrame | None = None
) -> DataFrame:
    """Every overdraft with drawn amount, maturity band, collections, ratios to the limit and account officer.

    Overdrafts are few, so credits are reduced to their accounts before they are summed.
    """
    books = accounts.filter(F.col("overdraft_start").isNotNull())
    of_books = txns.join(books.select("account_id"), "account_id", "left_semi")
    zero = F.lit(0).cast("decimal(18,2)")
    ratio = lambda c: percent_of(F.coalesce(c, zero), F.col("overdraft_limit"))
    owned = books.join(clients.select("client_id", "client_name", "referred_by_id"), "client_id")
    return (
        left_join_known(owned, referrers(clients, "account_officer"), "referred_by_id")
        .join(collections(of_books, as_of, last_known), "account_id", "left")
        .select(
            "account_id", "account_no", "client_name", "overdraft_limit",
            F.col("balance").alias("principal_balance"),
            (F.col("overdraft_limit") + F.col("balance")).alias("overdrawn_amount"),
            F.col("overdraft_start").alias("disbursement_date"),
            F.col("overdraft_end").alias("maturity_date"),
            bands.maturity_band(F.col("overdraft_end"), as_of).alias("remaining_days_to_maturity"),
            "last_collection_date",
            F.coalesce("one_month_collection", zero).alias("one_month_collection"),
            F.coalesce("three_month_collection", zero).alias("three_month_collection"),
            percent_text(ratio(F.col("one_month_collection"))).alias("one_month_ratio"),
            percent_text(ratio(F.col("three_month_collection"))).alias("three_month_ratio"),
            "account_officer",
        )
    )


def overdrafts_granted(accounts: DataFrame, clients: DataFrame, on: DateLike) -> DataFrame:
    return (
        accounts.filter(F.col("overdraft_start") == day(on))
        .join(clients.select("client_id", "client_name"), "client_id")
        .select("account_id", "account_no", "client_name", "overdraft_limit", "overdraft_start", "overdraft_end")
    )


def term_deposit_maturity(deposits: DataFrame, as_of: DateLike) -> DataFrame:
    return deposits.select(
        "account_id", "client_id", "deposit_period", "deposit_amount", "maturity_amount", "start_date", "maturity_date",
        F.datediff("maturity_date", day(as_of)).alias("days_to_maturity"),
        bands.maturity_band(F.col("maturity_date"), as_of).alias("maturity_band"),
    )


def deposits_expected_vs_actual(deposits: DataFrame) -> DataFrame:
    """Maturing amount against current balance per maturity date."""
    return deposits.groupBy("maturity_date").agg(
        F.count(F.lit(1)).alias("deposits"),
        F.sum("maturity_amount").alias("expected_amount"),
        F.sum("balance").alias("actual_balance"),
    )


def fresh_or_rollover(txns: DataFrame, deposit_product: int, app_users: Sequence[int], accounts: DataFrame) -> DataFrame:
    """Deposit bookings: 'Fresh' unless the client has a debit on a deposit account the same day."""
    on_deposit = txns.filter((F.col("product_id") == deposit_product) & (F.col("is_reversed") == "No"))
    liquidated = (
        on_deposit.filter(F.col("type_enum") == 2)
        .select("client_id", F.to_date("transaction_date").alias("booked_on"))
        .distinct()
        .withColumn("liquidated", F.lit(True))
    )
    channel = F.when(F.col("submittedby_userid").isin(*app_users), "app booking").otherwise("manual booking")
    return (
        on_deposit.filter(F.col("type_enum") == 1)
        .withColumn("booked_on", F.to_date("transaction_date"))
        .join(liquidated, ["client_id", "booked_on"], "left")
        .join(accounts.select("account_id", "submittedby_userid"), "account_id", "left")
        .select(
            "transaction_id", "client_id", "account_no", "amount", "booked_on",
            channel.alias("booking_channel"),
            F.when(F.col("liquidated"), "Roll over").otherwise("Fresh").alias("booking_type"),
        )
    )
