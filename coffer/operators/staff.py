"""Staff referrals, deposit drive, performance, openings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions.dates import DateLike, as_date, day, last_full_month
from coffer.functions.measures import count_when, sum_when
from coffer.operators.joins import left_join_known, referrers
from coffer.operators.ledger import latest_running_balance

OTHERS = "others"


def with_referrer(clients: DataFrame) -> DataFrame:
    """Clients with the name of who referred them.

    Few clients refer others, so the right side is reduced to those and Spark may send it to all tasks; where it may not, a
    referrer that owns a large share of the clients is a key that adaptive execution splits.
    """
    people = clients.select("client_id", "client_name", "referred_by_id")
    return left_join_known(people, referrers(clients, "referrer_name"), "referred_by_id")


def downlines(accounts: DataFrame, clients: DataFrame, loans: DataFrame) -> DataFrame:
    """Open accounts and loans of all referred clients under their referrer, labelled deposit, overdraft or loan."""
    referred = clients.filter(F.col("referred_by_id").isNotNull()).select("client_id", "client_name", "referred_by_id")
    held = accounts.filter(F.col("closedon_date").isNull()).select(
        "client_id", F.col("account_id").alias("item_id"), "product_name", F.col("balance").alias("amount"),
        F.when(F.col("balance") < 0, "overdraft").otherwise("deposit").alias("kind"),
    )
    lent = loans.select(
        "client_id", F.col("loan_id").alias("item_id"), F.lit("Loan").alias("product_name"),
        F.col("principal_disbursed").alias("amount"), F.lit("loan").alias("kind"),
    )
    return held.unionByName(lent).join(referred, "client_id").select(
        "referred_by_id", "client_id", "client_name", "item_id", "product_name", "amount", "kind"
    )


def deposit_drive(
    txns: DataFrame, clients: DataFrame, staff: DataFrame, deposit_product: int, since: DateLike, until: DateLike
) -> DataFrame:
    """Inflow, outflow and term-deposit inflow per staff member through referred clients, 'others' for no referrer.

    Movements are summed per client before the join, so a referrer with many clients brings one row per client.
    """
    moves = (
        txns.filter(
            F.col("type_enum").isin(1, 2) & (F.col("transaction_date") >= day(since)) & (F.col("transaction_date") < day(until))
        )
        .groupBy("client_id")
        .agg(
            sum_when(F.col("type_enum") == 1, "amount").alias("total_inflow"),
            sum_when(F.col("type_enum") == 2, "amount").alias("total_outflow"),
            sum_when((F.col("type_enum") == 1) & (F.col("product_id") == deposit_product), "amount").alias("fd_inflow"),
        )
    )
    measures = ("total_inflow", "total_outflow", "fd_inflow")
    key = F.coalesce(F.col("referred_by_id").cast("string"), F.lit(OTHERS))
    driven = (
        moves.join(clients.select("client_id", "referred_by_id"), "client_id")
        .groupBy(key.alias("staff_id"))
        .agg(*[F.sum(c).alias(c) for c in measures])
    )
    others = staff.sparkSession.range(1).select(F.lit(OTHERS).alias("staff_id"), F.lit("").alias("staff_name"))
    listed = staff.select(F.col("staff_id").cast("string").alias("staff_id"), "staff_name").unionByName(others)
    zero = F.lit(0).cast("decimal(38,2)")
    return listed.join(driven, "staff_id", "left").select(
        "staff_id", "staff_name", *[F.coalesce(c, zero).alias(c) for c in measures]
    )


def deposit_drive_pivot(
    txns: DataFrame, clients: DataFrame, days: Sequence[DateLike], deposit_product: int
) -> DataFrame:
    """Inflow and term-deposit inflow per referrer with one pair of columns per day of a given list."""
    dates = [as_date(d) for d in days]
    inflow = (
        txns.filter(
            (F.col("type_enum") == 1)
            & (F.col("transaction_date") >= day(min(dates)))
            & (F.col("transaction_date") < day(max(dates), 1))
        )
        .withColumn("on", F.date_format("transaction_date", "yyyy_MM_dd"))
        .groupBy("client_id", "on")
        .agg(F.sum("amount").alias("inflow"),
             sum_when(F.col("product_id") == deposit_product, "amount").alias("fd_inflow"))
    )
    staff_key = F.coalesce(F.col("referred_by_id").cast("string"), F.lit(OTHERS)).alias("staff_id")
    return (
        inflow.join(clients.select("client_id", "referred_by_id"), "client_id")
        .groupBy(staff_key)
        .pivot("on", [d.strftime("%Y_%m_%d") for d in dates])
        .agg(F.sum("inflow").alias("inflow"), F.sum("fd_inflow").alias("fd_inflow"))
        .na.fill(0)
    )


def staff_month_pivot(loans: DataFrame, clients: DataFrame, year: int, months: Sequence[int]) -> DataFrame:
    """Loan value and count per referrer, one pair of columns per month of a year."""
    names = [f"{year}_{m:02d}" for m in months]
    monthly = (
        loans.filter(F.year("disbursedon_date") == year)
        .withColumn("month", F.date_format("disbursedon_date", "yyyy_MM"))
        .filter(F.col("month").isin(names))
        .groupBy("client_id", "month")
        .agg(F.sum("principal_disbursed").alias("value"), F.count(F.lit(1)).alias("count"))
    )
    return (
        monthly.join(clients.filter(F.col("referred_by_id").isNotNull()).select("client_id", "referred_by_id"), "client_id")
        .groupBy("referred_by_id")
        .pivot("month", names)
        .agg(F.sum("value").alias("value"), F.sum("count").alias("count"))
    )


def staff_balance_pivot(month_ends: DataFrame, clients: DataFrame, months: Sequence[str]) -> DataFrame:
    """Month-end total and number of non-zero balances per referrer, one pair of columns per month (``yyyy-MM``).

    Balances are summed per client before they meet the referrers.
    """
    per_client = (
        month_ends.withColumn("month", F.date_format("date", "yyyy-MM"))
        .filter(F.col("month").isin(list(months)))
        .groupBy("client_id", "month")
        .agg(F.sum("closing_balance").alias("value"), F.count(F.when(F.col("closing_balance") != 0, 1)).alias("count"))
    )
    referred = clients.filter(F.col("referred_by_id").isNotNull()).select("client_id", "referred_by_id")
    return (
        per_client.join(referred, "client_id")
        .groupBy("referred_by_id")
        .pivot("month", list(months))
        .agg(F.sum("value").alias("value"), F.sum("count").alias("count"))
    )


def corporate_accounts_opened(accounts: DataFrame, clients: DataFrame, product: int, since: DateLike, until: DateLike) -> DataFrame:
    """Corporate accounts approved in a span, parent or sub by the client, with the referrer's name."""
    opened = accounts.filter(
        (F.col("product_id") == product) & (F.col("approvedon_date") >= day(since)) & (F.col("approvedon_date") < day(until))
    )
    people = clients.select("client_id", "client_name", "referred_by_id",
                            F.when(F.col("referred_by_id").isNull(), "parent").otherwise("sub").alias("level"))
    owned = opened.join(people, "client_id", "left")
    return left_join_known(owned, referrers(clients, "referrer_name"), "referred_by_id").select(
        "account_no", "product_name", "client_name", "approvedon_date", "level", "referrer_name"
    )


def signups_last_month(clients: DataFrame, as_of: DateLike) -> DataFrame:
    return (
        clients.filter(last_full_month(F.col("activation_date"), as_of))
        .groupBy("activation_date")
        .agg(F.count(F.lit(1)).alias("signups"),
             count_when(F.col("onboard_channel") == "MobileApp").alias("app_signups"))
    )


def subaccount_last_txn(accounts: DataFrame, clients: DataFrame, txns: DataFrame, product: int) -> DataFrame:
    """Accounts of a product with the date and balance of their last movement.

    Movements are reduced to the product at the scan; the last balance is their sum, so one aggregation gives both.
    """
    last = latest_running_balance(txns.filter(F.col("product_id") == product)).select(
        "account_id", F.col("last_transaction_date").cast("date").alias("last_transaction_date"),
        F.col("running_balance").alias("balance_at_last_transaction"),
    )
    return (
        accounts.filter(F.col("product_id") == product)
        .join(clients.select("client_id", "client_name"), "client_id")
        .join(last, "account_id", "left")
        .select("account_id", "account_no", "client_name", "product_name", "balance", "last_transaction_date",
                "balance_at_last_transaction")
    )
