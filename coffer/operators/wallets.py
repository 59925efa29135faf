"""Wallet statements, flows, API calls and the weekly summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions.dates import DateLike, day, last_days
from coffer.functions.measures import total
from coffer.functions.text import thousands
from coffer.operators.marts import intra_inter_measures


def without_parties(rows: DataFrame, parties: DataFrame, key: str, name: str, excluded: Sequence[str]) -> DataFrame:
    """Rows of all parties but the named ones. Only the excluded names' keys are matched against the rows."""
    return rows.join(parties.filter(F.col(name).isin(*excluded)).select(key), key, "left_anti")


def wallet_statement(wallet_txns: DataFrame, banks: DataFrame, wallets: DataFrame) -> DataFrame:
    """All statement rows of all wallets in one frame, labelled by section.

    Outflows are taken whatever their response; inflows are as booked; initial inflows are a section of their own. The
    sender's bank is named for inflows only. Write it with ``sinks.write_per_party`` for one output per wallet.
    """
    section = F.initcap(F.lower("transaction_type"))
    named = banks.select(F.col("bank_code").alias("from_bank"), F.col("bank_name").alias("from_bank_name"))
    inward = F.col("transaction_type") != "OUTFLOW"
    return (
        wallet_txns.filter(F.col("transaction_type").isin("OUTFLOW", "INFLOW", "INITIAL INFLOW"))
        .join(named, "from_bank", "left")
        .join(wallets, "wallet_id", "left")
        .select(
            "wallet_name", section.alias("section"), "transaction_id", "statement_ids",
            F.when(inward, F.col("from_account_no")).alias("from_account_no"),
            F.when(inward, F.col("from_bank_name")).alias("from_bank_name"),
            "to_account_no", "session_id", "amount", "transaction_response", "time",
        )
    )


def pooled_multi_leg(wallet_txns: DataFrame, wallets: DataFrame, failed: Sequence[str] = ("02", "99")) -> DataFrame:
    """Transaction ids of a wallet with more than one accepted leg, initial inflows left out."""
    return (
        wallet_txns.filter((F.col("transaction_type") != "INITIAL INFLOW") & ~F.col("transaction_response").isin(*failed))
        .groupBy("wallet_id", "transaction_id")
        .agg(F.count(F.lit(1)).alias("legs"), F.sum("amount").alias("amount"))
        .filter(F.col("legs") > 1)
        .join(wallets, "wallet_id", "left")
        .drop("wallet_id")
    )


def accepted_flows(wallet_txns: DataFrame) -> DataFrame:
    return wallet_txns.filter(
        (F.col("transaction_response") == "00") & F.col("transaction_type").isin("OUTFLOW", "INFLOW")
    )


def intra_inter_by_wallet(wallet_txns: DataFrame, wallets: DataFrame) -> DataFrame:
    """Own-bank and other-bank volume and value per wallet, direction and day."""
    return (
        accepted_flows(wallet_txns)
        .groupBy("wallet_id", "transaction_type", F.to_date("time").alias("date"))
        .agg(*intra_inter_measures())
        .join(wallets, "wallet_id", "left")
        .drop("wallet_id")
    )


def flow_totals(wallet_txns: DataFrame, wallets: DataFrame) -> DataFrame:
    """Volume and value per wallet and direction, and the direction's grand total beside them."""
    per_wallet = (
        accepted_flows(wallet_txns)
        .groupBy("transaction_type", "wallet_id")
        .agg(F.count(F.lit(1)).alias("volume"), F.sum("amount").alias("value"))
    )
    directions = ("OUTFLOW", "INFLOW")
    sums = [F.sum(F.when(F.col("transaction_type") == d, F.col(c))).alias(f"{d}_{c}") for d in directions for c in ("volume", "value")]
    totals = per_wallet.agg(*sums).select(F.struct("*").alias("t")).scalar()
    one = per_wallet.withColumn("_totals", totals)
    for c in ("volume", "value"):
        picked = F.when(F.col("transaction_type") == directions[0], F.col(f"_totals.{directions[0]}_{c}"))
        one = one.withColumn(f"total_{c}", picked.otherwise(F.col(f"_totals.{directions[1]}_{c}")))
    return one.drop("_totals").join(wallets, "wallet_id", "left").drop("wallet_id")


def top_wallets(wallet_txns: DataFrame, wallets: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` wallets with the most outflows, by name where they tie."""
    return (
        accepted_flows(wallet_txns)
        .filter(F.col("transaction_type") == "OUTFLOW")
        .groupBy("wallet_id")
        .agg(F.count(F.lit(1)).alias("volume"), F.sum("amount").alias("value"))
        .join(wallets, "wallet_id", "left")
        .orderBy(F.col("volume").desc(), "wallet_name")
        .limit(n)
        .select("wallet_name", "volume", "value")
    )


def calls_by(calls: DataFrame, *keys: str) -> DataFrame:
    return calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("calls"))


def top_clients(calls: DataFrame, n: int = 5) -> DataFrame:
    return calls_by(calls, "subscriber").orderBy(F.col("calls").desc(), "subscriber").limit(n)


def weekly_kpis(
    calls: DataFrame, wallet_txns: DataFrame, call_groups: dict[str, Sequence[str]], mean_deposits: DataFrame
) -> DataFrame:
    """KPI list as rows (metric, value as text).

    Per call group: number of calls and the busiest client. Then volume and value of all flows and of each direction,
    and the sum of the accounts' mean deposits.
    Calls are summed per client first, so the top client of each group comes out of the small table.
    """
    per_client = calls.groupBy("subscriber").agg(
        *[F.count(F.when(F.col("resource_consumed").isin(*names), 1)).alias(g) for g, names in call_groups.items()]
    )
    call_row = per_client.agg(
        *[F.sum(g).alias(f"{g}_calls") for g in call_groups],
        *[F.max(F.struct(F.col(g), F.col("subscriber"))).alias(f"{g}_top") for g in call_groups],
    ).select(
        *[thousands(F.col(f"{g}_calls")).alias(f"Total {g} calls") for g in call_groups],
        *[F.when(F.col(f"{g}_top.{g}") > 0, F.col(f"{g}_top.subscriber")).alias(f"Top {g} client") for g in call_groups],
    )
    side = F.col("transaction_type")
    flow_row = wallet_txns.agg(
        F.count(F.lit(1)).alias("v"), total("amount").alias("a"),
        F.count(F.when(side == "OUTFLOW", 1)).alias("ov"), F.sum(F.when(side == "OUTFLOW", F.col("amount"))).alias("oa"),
        F.count(F.when(side == "INFLOW", 1)).alias("iv"), F.sum(F.when(side == "INFLOW", F.col("amount"))).alias("ia"),
    ).select(
        thousands(F.col("v")).alias("Total transfer volume"), thousands(F.col("a"), 2, "N").alias("Total transfer value"),
        thousands(F.col("ov")).alias("Total outflow volume"), thousands(F.col("oa"), 2, "N").alias("Total outflow value"),
        thousands(F.col("iv")).alias("Total inflow volume"), thousands(F.col("ia"), 2, "N").alias("Total inflow value"),
    )
    deposit_row = mean_deposits.agg(F.sum(F.round("avg_deposit", 2).cast("decimal(28,2)")).alias("d")).select(
        thousands(F.col("d"), 2, "N").alias("Cumulative average deposit")
    )
    return kpi_rows(call_row).unionByName(kpi_rows(flow_row)).unionByName(kpi_rows(deposit_row))


def kpi_rows(one_row: DataFrame) -> DataFrame:
    """A one-row KPI table as (metric, value)."""
    texts = one_row.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in one_row.columns])
    return texts.unpivot([], [F.col(f"`{c}`") for c in texts.columns], "metric", "value")


def mean_deposit_last_week(held: DataFrame, accounts: DataFrame, as_of: DateLike) -> DataFrame:
    """Mean daily balance over the seven days before ``as_of`` of each listed account, from ``ledger.balance_intervals``.

    A balance weighs the days of the week that it holds; unknown days do not count.
    """
    first, last = F.date_sub(day(as_of), 7).cast("date"), F.date_sub(day(as_of), 1).cast("date")
    days = F.datediff(F.least("until", last), F.greatest("begins", first)) + 1
    known = F.when(F.col("closing_balance").isNotNull(), F.col("days"))
    return (
        held.withColumn("days", days).filter(F.col("days") > 0)
        .join(accounts.select("account_no"), "account_no", "left_semi")
        .groupBy("account_no")
        .agg((F.sum(F.col("closing_balance") * F.col("days")).cast("double") / F.sum(known)).alias("avg_deposit"))
    )


def bills_of_week(purchases: DataFrame, billers: DataFrame, as_of: DateLike) -> DataFrame:
    """Purchases from the wallet channel in the seven days before ``as_of``, with the biller's name."""
    week = purchases.filter(last_days(F.col("transaction_date"), as_of, 7) & (F.col("channel") == "WALLET"))
    return week.join(billers, "biller_id", "left")
