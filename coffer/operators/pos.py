"""Terminals, POS transactions, sweeps and cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions.bands import card_type_by_charge
from coffer.functions.text import pan_head, pan_tail


def pos_transactions(pos: DataFrame, accounts: DataFrame, clients: DataFrame, vendor: str, accepted: bool = True) -> DataFrame:
    """POS rows with the client, charge (amount less settled) and masked card parts."""
    kept = pos.filter((F.col("status_code") == "00") if accepted else (F.col("status_code") != "00"))
    owner = accounts.select("account_no", "client_id", "product_id", "product_name").join(
        clients.select("client_id", "client_name"), "client_id", "left"
    )
    return kept.join(owner, "account_no", "left").select(
        "transaction_id", "transaction_date", "terminal_id", "client_id", "client_name", "status_code",
        F.lit(vendor).alias("vendor"), "amount", "settled_amount",
        (F.col("amount") - F.col("settled_amount")).alias("charges"), "account_no", "product_name",
        pan_head(F.col("card_pan")).alias("first_six_digits"), pan_tail(F.col("card_pan")).alias("last_four_digits"),
    )


def pos_terminals(pos: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """Terminals in use with account, product and owner; volume, value and charges of accepted rows."""
    used = (
        pos.filter(F.col("status_code") == "00")
        .groupBy("terminal_id", "account_no")
        .agg(F.count(F.lit(1)).alias("volume"), F.sum("amount").alias("value"),
             F.sum(F.col("amount") - F.col("settled_amount")).alias("charges"))
    )
    return (
        used.join(accounts.select("account_no", "client_id", "product_name"), "account_no", "left")
        .join(clients.select("client_id", "client_name"), "client_id", "left")
        .select("terminal_id", "account_no", "product_name", "client_name", "volume", "value", "charges")
    )


def transfers_two_legs(
    transfers: DataFrame, legs: DataFrame, clients: DataFrame, senders: DataFrame, bank: str
) -> DataFrame:
    """Transfers with both legs, both accounts and both clients.

    ``senders`` holds the ids of the sending transactions that count (those on transit accounts); transfers are reduced
    to them first. ``legs`` carry a running balance and are costly, so they are met once: each transfer is split into a
    sending and a receiving row, the rows are joined to the legs and put together again by transfer.
    """
    ends = transfers.join(senders.select(F.col("transaction_id").alias("from_txn")), "from_txn", "left_semi").select(
        "transfer_id", "transfer_date", "description", "from_txn",
        F.explode(F.array(F.struct(F.lit("sender").alias("role"), F.col("from_txn").alias("transaction_id")),
                          F.struct(F.lit("receiver").alias("role"), F.col("to_txn").alias("transaction_id")))).alias("end"),
    ).select("transfer_id", "transfer_date", "description", "from_txn", "end.role", "end.transaction_id")
    leg = legs.select("transaction_id", "client_id", "account_no", "amount", "running_balance")
    side = F.struct("account_no", "client_id", "client_name", "running_balance", "amount")
    whole = (
        ends.join(leg, "transaction_id")
        .join(clients.select("client_id", "client_name"), "client_id")
        .groupBy("transfer_id", "transfer_date", "description", "from_txn")
        .agg(F.max(F.when(F.col("role") == "sender", side)).alias("s"),
             F.max(F.when(F.col("role") == "receiver", side)).alias("r"))
        .filter(F.col("s").isNotNull() & F.col("r").isNotNull())
    )
    return whole.select(
        "transfer_date",
        F.col("r.account_no").alias("receiver_account_no"), F.col("r.client_id").alias("receiver_client_id"),
        F.col("r.client_name").alias("receiver_name"), F.col("r.running_balance").alias("receiver_balance"),
        F.col("s.amount").alias("amount"), F.lit(bank).alias("receiver_bank"),
        F.col("s.account_no").alias("sender_account_no"), F.col("s.client_id").alias("sender_client_id"),
        F.col("s.client_name").alias("sender_name"), F.col("s.running_balance").alias("sender_balance"),
        F.col("from_txn").alias("resource_id"), F.lit(bank).alias("sender_bank"), F.col("description").alias("narration"),
    )


def audit_users(audit: DataFrame, users: DataFrame, accounts: DataFrame, clients: DataFrame, spans: dict[str, tuple[int, int]]) -> DataFrame:
    """Audit rows with account numbers cut out of the resource text and the names of their owners.

    ``spans`` maps an account role to its (start, length) in the text.
    """
    owner = accounts.select("account_no", "client_id").join(clients.select("client_id", "client_name"), "client_id")
    out = audit.join(users.select(F.col("user_id").alias("maker_id"), "username"), "maker_id", "left")
    for role, (start, length) in spans.items():
        out = out.withColumn(f"{role}_account_no", F.trim(F.substring("resource", start, length)))
        out = out.join(
            owner.select(F.col("account_no").alias(f"{role}_account_no"), F.col("client_name").alias(f"{role}_account_name")),
            f"{role}_account_no", "left",
        )
    return out


def card_transactions(fresh: DataFrame, owners: DataFrame) -> DataFrame:
    """New card transactions with the owner of the card's account, client or group."""
    return fresh.join(owners.select("account_id", "account_no", "owner_id", "owner_name"), "account_id", "left")


def terminal_wallet_load(fresh: DataFrame, banks: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """New wallet rows of terminals with the sender's bank and the receiving client."""
    named = banks.select(F.col("bank_code").alias("from_bank"), "bank_name")
    owner = accounts.select(F.col("account_no").alias("to_account_no"), "client_id").join(
        clients.select("client_id", "client_name"), "client_id"
    )
    return fresh.join(named, "from_bank", "left").join(owner.drop("client_id"), "to_account_no", "left").select(
        "transaction_id", "statement_ids", "transaction_type", "transaction_response", "from_account_no", "from_bank",
        "bank_name", "to_account_no", "client_name", "amount", "time",
    )


def card_requests(requests: DataFrame, charges: DataFrame, accounts: DataFrame, groups: DataFrame) -> DataFrame:
    """Card requests with owner (client or group), charge and the card kind the charge stands for."""
    owner = accounts.select("account_id", "account_no", F.col("client_id").alias("owner_client"), "group_id").join(
        groups, "group_id", "left"
    )
    return (
        requests.join(charges, "card_id", "left")
        .join(owner, "account_id", "left")
        .select("card_id", "client_id", "account_no", F.coalesce("owner_client", "group_id").alias("owner_id"),
                "group_name", F.col("charge").alias("amount_charged"),
                card_type_by_charge(F.col("charge")).alias("card_type"))
    )


def cards_produced(cards: DataFrame, clients: DataFrame, kinds: Sequence[str] = ("PHYSICAL", "VIRTUAL")) -> DataFrame:
    """Cards with their client's name."""
    return cards.filter(F.col("pan_type").isin(*kinds)).join(
        clients.select("client_id", "client_name"), "client_id", "left"
    ).select("card_id", "client_id", "client_name", "pan_type", "card_status", "expiry_code", "date_created")
