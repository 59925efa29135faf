"""Limits, large transactions, compliance and settlement position."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions import bands
from coffer.functions.dates import DateLike, cycle_start, on_day
from coffer.functions.measures import percent_of, total
from coffer.functions.text import percent_text, thousands
from coffer.operators.joins import left_join_known, referrers
from coffer.operators.running import running_total_over_day

# Smallest reported amount per tier, and remarks that are not reported.
TIER_THRESHOLDS = {"Tier 1": 100_000, "Tier 2": 200_000, "Tier 3": 200_000}
EXCLUDED_REMARKS = ("%FD Book%", "%Roll over%", "%Loan Disbu%", "%Partial Liquid%")
ALERT_PRODUCTS = (29, 33)


def large_transactions(txns: DataFrame, minimum: int, products: Sequence[int] = ALERT_PRODUCTS) -> DataFrame:
    """Unreversed credits and debits of at least ``minimum`` on the products, without the excluded remarks."""
    kept = F.lit(True)
    for pattern in EXCLUDED_REMARKS:
        kept = kept & ~F.col("remarks").ilike(pattern)
    return txns.filter(
        F.col("type_enum").isin(1, 2)
        & (F.col("is_reversed") == "No")
        & (F.col("amount") >= minimum)
        & F.col("product_id").isin(*products)
        & kept
    )


def tier_alerts(
    txns: DataFrame, clients: DataFrame, thresholds: Mapping[str, int] = TIER_THRESHOLDS, on: DateLike | None = None
) -> DataFrame:
    """Large transactions by the threshold of the client's tier, all tiers in one pass; of one day, where ``on`` is given.

    The day and the lowest threshold are filters at the scan, before the join to clients. A ``running_balance`` that the
    transactions carry is shown.
    """
    if on is not None:
        txns = txns.filter(on_day(F.col("transaction_date"), on))
    balance = [c for c in ("running_balance",) if c in txns.columns]
    floor = F.lit(None).cast("int")
    for tier, amount in thresholds.items():
        floor = F.when(F.col("client_tier") == tier, amount).otherwise(floor)
    candidates = large_transactions(txns, min(thresholds.values()))
    return (
        candidates.join(clients.select("client_id", "client_tier", "client_name", "mobile_number"), "client_id")
        .filter(F.col("amount") >= floor)
        .select("transaction_id", "client_id", "client_name", "client_tier", "account_no", "product_name",
                "transaction_type", "amount", "transaction_date", "remarks", "mobile_number", *balance)
    )


def repeat_alerts(alerts: DataFrame, tier: str = "Tier 3") -> DataFrame:
    """Alerts of a tier whose client has more than one alert in the same direction on the same day."""
    marked = alerts.filter(F.col("client_tier") == tier).withColumn("alert_date", F.to_date("transaction_date"))
    keys = ["client_id", "transaction_type", "alert_date"]
    repeated = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("hits")).filter(F.col("hits") > 1)
    return marked.join(repeated, keys)


def manual_accounts_opened(
    accounts: DataFrame, clients: DataFrame, risk: DataFrame, app_user: int, products: Sequence[int]
) -> DataFrame:
    """Accounts not opened by the app user, with risk band and account officer (the client's referrer)."""
    opened = accounts.filter((F.col("submittedby_userid") != app_user) & F.col("product_id").isin(*products))
    owned = (
        opened.join(clients.select("client_id", "client_name", "client_tier", "referred_by_id"), "client_id", "left")
        .join(risk, "client_id", "left")
    )
    return (
        left_join_known(owned, referrers(clients, "account_officer_name"), "referred_by_id")
        .select("account_id", "account_no", "client_id", "client_name", "client_tier", "product_name",
                F.col("approvedon_date").alias("activation_date"), "risk_score",
                bands.risk_band(F.col("risk_score")).alias("aml_risk_rating"), "account_officer_name")
    )


def limit_increases(today: DataFrame, before: DataFrame) -> DataFrame:
    """Clients whose daily or single limit is above the one of the earlier snapshot."""
    earlier = before.select(
        "client_id",
        F.col("daily_withdraw_limit").alias("daily_limit_before"),
        F.col("max_transaction_limit").alias("single_limit_before"),
    )
    return (
        today.join(earlier, "client_id")
        .filter(
            (F.col("daily_withdraw_limit") > F.col("daily_limit_before"))
            | (F.col("max_transaction_limit") > F.col("single_limit_before"))
        )
        .select("client_id", "daily_withdraw_limit", "daily_limit_before", "max_transaction_limit", "single_limit_before")
    )


def limit_increase_details(increases: DataFrame, accounts: DataFrame, txns: DataFrame, clients: DataFrame) -> DataFrame:
    """Increases with the client's first account number, tier and last unreversed movement.

    Few clients have an increase, so accounts and movements are reduced to theirs before they are summed up.
    """
    raised = increases.select("client_id")
    first_account = accounts.join(raised, "client_id", "left_semi").groupBy("client_id").agg(F.min("account_no").alias("account_no"))
    last_move = (
        txns.filter(F.col("type_enum").isin(1, 2) & (F.col("is_reversed") == "No"))
        .join(raised, "client_id", "left_semi")
        .groupBy("client_id")
        .agg(F.max("transaction_date").cast("date").alias("last_transaction_date"))
    )
    return (
        increases.join(clients.select("client_id", "client_name", "client_tier"), "client_id")
        .join(first_account, "client_id", "left")
        .join(last_move, "client_id", "left")
    )


def new_account_compliance(
    accounts: DataFrame, clients: DataFrame, risk: DataFrame, blocks: DataFrame, on: DateLike, products: Sequence[int]
) -> DataFrame:
    """Clients activated on a day: first account, opening channel, risk band, last block note.

    The block condition is part of the join, so accounts without a block stay.
    """
    new = clients.filter(F.col("activation_date") == F.lit(on)).select("client_id", "client_name", "activation_date")
    opened = accounts.filter(F.col("product_id").isin(*products)).join(new, "client_id")
    blocked = blocks.filter(F.col("sub_status").isin("BLOCK DEBIT", "BLOCK CREDIT"))
    latest = blocked.groupBy("account_id").agg(
        F.max_by(F.struct("sub_status", "note"), F.struct("created_date", "note")).alias("b")
    )
    return (
        opened.join(latest, "account_id", "left")
        .groupBy("client_id", "client_name", "activation_date")
        .agg(
            F.min("account_no").alias("account_no"),
            F.min_by(F.col("submittedby_userid"), F.col("account_no")).alias("opened_by"),
            F.max("b.sub_status").alias("sub_status"),
        )
        .join(risk, "client_id", "left")
        .withColumn("aml_risk_rating", bands.risk_band(F.col("risk_score")))
    )


def limit_utilisation(payments: DataFrame, limit: int) -> DataFrame:
    """Count, amount and percentage of a daily limit per day."""
    return payments.groupBy("date").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        total("amount").alias("amount_used"),
    ).select(
        "date", "transaction_count", "amount_used", F.lit(limit).alias("limit_amount"),
        percent_of(F.col("amount_used"), F.lit(limit)).alias("percent_utilised"),
    )


def first_in_bands(running: DataFrame, limit: float, first_band: int = 50) -> DataFrame:
    """First event per day and 10 % band, from ``first_band`` to below 100 %, of events with the amount ``used`` up to each.

    The first event is a ``min`` with map-side combine.
    """
    band = F.floor(F.col("used") * 10 / F.lit(limit)) * 10
    return (
        running.withColumn("band", band.cast("int"))
        .filter((F.col("band") >= first_band) & (F.col("band") < 100))
        .groupBy("date", "band")
        .agg(F.min(F.struct("ts", "id", "used")).alias("first"))
        .select("date", "band", F.col("first.ts").alias("reached_at"), F.col("first.id").alias("event_id"),
                F.col("first.used").alias("amount_used"))
    )


def limit_band_alerts(events: DataFrame, limit: float, first_band: int = 50) -> DataFrame:
    """First event of each day that reaches each 10 % band of the limit, from ``first_band`` to below 100 %.

    ``events``: date, ts, id, amount. A day's total is never scanned in one task, see ``running_total_over_day``.
    """
    return first_in_bands(running_total_over_day(events, "date", "ts", "id", "amount", "used"), limit, first_band)


def settlement_position(
    outward: DataFrame, inward: DataFrame, now: dt.datetime, threshold: int, cut_hour: int = 14,
    holidays: Iterable[DateLike] = (),
) -> DataFrame:
    """Outward less inward value since the start of the settlement cycle, against a threshold. One row.

    ``outward`` and ``inward``: ts, amount. Both sides go through one aggregation instead of a join of two rows.
    """
    start = F.lit(cycle_start(now, cut_hour, holidays).isoformat(sep=" ")).cast("timestamp_ntz")
    until = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    sides = outward.select("ts", "amount", F.lit("out").alias("side")).unionByName(
        inward.select("ts", "amount", F.lit("in").alias("side"))
    ).filter((F.col("ts") >= start) & (F.col("ts") < until))
    out, inn = F.col("side") == "out", F.col("side") == "in"
    amount = F.col("amount")
    zero = F.lit(0).cast("decimal(18,2)")
    position = sides.agg(
        F.count(F.when(out, 1)).alias("out_volume"),
        F.count(F.when(inn, 1)).alias("in_volume"),
        F.coalesce(F.sum(F.when(out, amount)), zero).alias("out_value"),
        F.coalesce(F.sum(F.when(inn, amount)), zero).alias("in_value"),
        F.min(F.when(out, F.col("ts"))).alias("out_start"),
        F.max(F.when(out, F.col("ts"))).alias("out_end"),
    )
    difference = F.col("out_value") - F.col("in_value")
    percent = percent_of(difference, F.lit(threshold))
    return position.select(
        "*", difference.alias("difference"), F.lit(threshold).alias("threshold"),
        (F.lit(threshold) - difference).alias("threshold_balance"), percent.alias("percent_consumption"),
        (percent >= 50).alias("alert"),
    )


def settlement_text(position: DataFrame) -> DataFrame:
    """The position as report text."""
    money = ("out_value", "in_value", "difference", "threshold", "threshold_balance")
    return position.select(
        thousands(F.col("out_volume")).alias("out_volume"), thousands(F.col("in_volume")).alias("in_volume"),
        *[thousands(F.col(c).cast("decimal(28,2)"), 2, "N ").alias(c) for c in money],
        percent_text(F.col("percent_consumption")).alias("percent_consumption"),
    )
