"""The KPI marts. Each is a declaration; ``kpi.period_kpi`` gives it its monthly and year-to-date form.

``tables`` is any object with the conformed tables as attributes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.functions import bands
from coffer.functions.dates import DateLike, as_date, date_spine, day
from coffer.functions.measures import count_by, count_when, sum_when, total, volume_value_by
from coffer.functions.text import strip_codes, suffix_resource
from coffer.operators.kpi import Mart, customers_and_mean

# Channels and response codes the reports count.
CHANNELS = ("MOBILE", "USSD", "CHATBOT")
ACCEPTED_CODES = ("00", "201", "200", "9000")
OWN_BANK = "999999"
FREE_TRANSFERS = 50
FAILED_STATUS = ("Fail", "Failed", "FAIL", "FAILED")


def _by_channel() -> list[Column]:
    return volume_value_by("channel", CHANNELS)


def _volume_value() -> list[Column]:
    return [F.count(F.lit(1)).alias("volume"), total("amount").alias("value")]


def _in_channels(df: DataFrame) -> DataFrame:
    return df.filter(F.col("channel").isin(*CHANNELS))


def _in_channels_or_unknown(df: DataFrame) -> DataFrame:
    return df.filter(F.col("channel").isin(*CHANNELS) | F.col("channel").isNull())


def _by_known_channel() -> list[Column]:
    """By channel, with the rows without one counted apart; totals hold them too."""
    return [count_when(F.col("channel").isNull()).alias("null_volume"), *_by_channel()]


def free_quota_transfers(txns: DataFrame) -> DataFrame:
    """Accepted outward transfers over the channels, to which a client's free quota applies."""
    return _in_channels(txns).filter(
        (F.col("partners") == "NIPCREDIT") & (F.col("type_enum") == 2) & (F.col("response_code") == "00")
    )


def _withdrawals(t) -> DataFrame:
    accepted = F.col("response_code").isin(*ACCEPTED_CODES)
    return _in_channels(t.transaction).filter((F.col("type_enum") == 2) & accepted)


def _retail_accounts(t, products: Sequence[int]) -> DataFrame:
    wanted = t.account.filter(F.col("product_id").isin(*products)).select(
        "account_id", "client_id", "product_name", "approvedon_date", "submittedby_userid"
    )
    people = t.client.select("client_id", "client_tier", "gender_code", "activation_date", "activatedon_userid")
    return wanted.join(people, "client_id")


def fixed_deposit_credits(t, holders: DataFrame, deposit_product: int) -> DataFrame:
    """Unreversed credits on deposit accounts of clients that hold one of ``holders`` accounts."""
    credits = t.transaction.filter(
        (F.col("is_reversed") == "No") & (F.col("product_id") == deposit_product) & (F.col("type_enum") == 1)
    )
    return credits.join(holders.select("client_id").distinct(), "client_id", "left_semi")


def either_end(transfers: DataFrame, legs: DataFrame, from_id: str, to_id: str, leg_id: str) -> DataFrame:
    """Transfers joined to a leg on either end: ``leg = to OR leg = from``.

    Two equi joins, united. The second leaves out transfers whose two ends are the same leg, which the OR would match
    only once, so no distinct over the result is needed.
    """
    to_side = transfers.join(legs, F.col(to_id) == F.col(leg_id))
    from_side = transfers.filter(~F.col(from_id).eqNullSafe(F.col(to_id))).join(legs, F.col(from_id) == F.col(leg_id))
    return to_side.unionByName(from_side)


def retail_marts(as_of: DateLike, retail: Sequence[int], account_products: Sequence[int], app_user: int) -> dict[str, Mart]:
    """Marts on client and account openings."""
    accounts = lambda t: _retail_accounts(t, retail)
    opened = lambda t: _retail_accounts(t, account_products)
    customers = lambda: [F.count("client_id").alias("customers")]
    return {
        "retail_customers": Mart(accounts, "activation_date", customers, as_of),
        "retail_tier": Mart(
            accounts, "activation_date",
            lambda: [*count_by("client_tier", {"Tier 1": "tier_1", "Tier 2": "tier_2", "Tier 3": "tier_3"}),
                     F.count("client_id").alias("total_customers")],
            as_of,
        ),
        "retail_accounts": Mart(
            opened, "approvedon_date", lambda: [F.count("account_id").alias("no_accounts")], as_of, ("product_name",)
        ),
        "retail_onboard_channel": Mart(
            accounts, "activation_date",
            lambda: [count_when(F.col("activatedon_userid") == app_user).alias("mobile"),
                     count_when(F.col("activatedon_userid") != app_user).alias("others")],
            as_of,
        ),
        "social_onboard": Mart(
            lambda t: t.client.filter(F.col("onboard_channel") == "WhatsApp"), "activation_date", customers, as_of
        ),
        "backend_onboard": Mart(
            lambda t: accounts(t).filter(F.col("submittedby_userid") != app_user), "activation_date",
            lambda: [F.count("client_id").alias("accounts")], as_of, grains=("monthly",),
        ),
        "retail_gender": Mart(
            lambda t: accounts(t).withColumn("gender", bands.decode("gender_code", bands.CLIENT_GENDER))
            .filter(F.col("gender").isNotNull()),
            "activation_date", lambda: [F.count(F.lit(1)).alias("customers")], as_of, ("gender",), ("ytd",),
        ),
        "card_issue": Mart(
            lambda t: t.card, "date_created", lambda: [F.count(F.lit(1)).alias("cards_issued")], as_of
        ),
        "card_status": Mart(
            lambda t: t.card, "date_created",
            lambda: [*count_by("pan_type", {"PHYSICAL": "total_physical", "VIRTUAL": "total_virtual"}),
                     *count_by("card_status", {"ACTIVE": "total_active", "EXPIRED": "total_expired",
                                               "BLOCKED": "total_blocked"})],
            as_of,
        ),
        "business_dropoff": Mart(
            lambda t: t.client.filter(F.col("image_id").isNull()), "activation_date",
            lambda: [F.count(F.lit(1)).alias("dropoffs")], as_of,
        ),
    }


def payment_marts(as_of: DateLike, deposit_product: int, liquid_products: Sequence[int], corporate: int,
                  voucher_codes: Sequence[str]) -> dict[str, Mart]:
    """Marts on account transactions, settlements, bills and cards."""
    successful_bills = lambda t: t.bill_only.filter(F.col("transaction_status") == "success")
    airtime = lambda t: t.airtime.filter(F.col("transaction_status") == "success")
    biller_count = lambda: [F.count(F.lit(1)).alias("biller_count")]

    def settled(partner: str, code_test: str) -> Callable[[object], DataFrame]:
        return lambda t: _in_channels(t.transaction).filter(F.col("partners") == partner).filter(code_test)

    failed = settled("NIPCREDIT", "response_code <> '00'")
    card_kinds = {"cashWithdrawal": "atm", "debitGoodsAndServices": "pos", "paymentFromAccount": "web",
                  "accountTransfer": "transfer"}

    def card_measures() -> list[Column]:
        out = []
        for kind, name in card_kinds.items():
            hit = F.col("transaction_type") == kind
            out += [count_when(hit).alias(f"{name}_volume"), sum_when(hit, "amount").alias(f"{name}_value")]
        return [*out, F.count(F.lit(1)).alias("total_volume"), total("amount").alias("total_value")]

    return {
        "intrabank": Mart(
            lambda t: _in_channels_or_unknown(t.transaction).filter(F.col("partners_description") == "Internal transfer"),
            "transaction_date", _by_known_channel, as_of,
        ),
        "interbank_failure": Mart(failed, "transaction_date", _by_channel, as_of),
        "avg_customer_transfers": Mart(_withdrawals, "transaction_date", lambda: customers_and_mean("client_id"), as_of),
        "interbank_out": Mart(
            lambda t: _in_channels_or_unknown(t.transaction).filter(
                (F.col("partners") == "NIPCREDIT") & (F.col("response_code") == "00")
            ),
            "transaction_date", _by_known_channel, as_of,
        ),
        "interbank_out_failed": Mart(failed, "transaction_date", _by_channel, as_of),
        "cardless": Mart(settled("CARDLESS", "response_code = '00'"), "transaction_date", _by_channel, as_of),
        "bills_by_channel": Mart(lambda t: _in_channels(successful_bills(t)), "transaction_date", _by_channel, as_of),
        "bills": Mart(successful_bills, "transaction_date", biller_count, as_of, ("biller_id",)),
        "airtime_by_channel": Mart(lambda t: _in_channels(airtime(t)), "transaction_date", _by_channel, as_of),
        "airtime": Mart(airtime, "transaction_date", biller_count, as_of, ("biller_id",)),
        "cards": Mart(
            lambda t: t.card_txn.filter(F.col("transaction_status") == "success"), "transaction_date", card_measures, as_of
        ),
        "account_product_txn": Mart(_withdrawals, "transaction_date", _by_channel, as_of, ("product_name",)),
        "fd_corporate": Mart(
            lambda t: fixed_deposit_credits(t, t.account.filter(F.col("product_id") == corporate), deposit_product),
            "transaction_date", lambda: [total("amount").alias("fd_amount")], as_of,
        ),
        "fd_retail": Mart(
            lambda t: fixed_deposit_credits(t, t.account.filter(F.col("product_id").isin(29, 31, 33)), deposit_product),
            "transaction_date", lambda: [total("amount").alias("fd_amount")], as_of,
        ),
        "product_liquidation": Mart(
            lambda t: either_end(
                t.transfer.filter(F.col("description").ilike("%liq%")),
                t.transaction.filter(F.col("product_id").isin(*liquid_products) & (F.col("type_enum") == 2))
                .select(F.col("transaction_id").alias("leg_id"), "product_name", "amount"),
                "from_txn", "to_txn", "leg_id",
            ),
            "transfer_date", _volume_value, as_of, ("product_name",),
        ),
        "corporate_txn": Mart(
            lambda t: t.transaction.filter((F.col("is_reversed") == "No") & (F.col("product_id") == corporate)),
            "transaction_date",
            lambda: [count_when(F.col("type_enum") == 2).alias("debit_volume"),
                     count_when(F.col("type_enum") == 1).alias("credit_volume"),
                     sum_when(F.col("type_enum") == 2, "amount").alias("debit_value"),
                     sum_when(F.col("type_enum") == 1, "amount").alias("credit_value")],
            as_of,
        ),
        "voucher": Mart(
            lambda t: t.transaction.filter((F.col("partners") == "VOUCHER") & (F.col("response_code") == "00"))
            .withColumn("voucher", strip_codes(F.col("third_party_name"), voucher_codes)),
            "transaction_date", _volume_value, as_of, ("voucher",),
        ),
        "qr_code": Mart(
            lambda t: t.card_txn.withColumnRenamed("transaction_type", "qr_type"), "transaction_date", _volume_value,
            as_of, ("qr_type", "transaction_status"),
        ),
        "business_payment": Mart(
            lambda t: t.transaction.filter((F.col("partners") == "TRANSFER") & (F.col("response_code") == "00")),
            "transaction_date", _volume_value, as_of,
        ),
        "loans": Mart(
            lambda t: t.loan.filter(F.col("disbursedon_date").isNotNull()), "disbursedon_date",
            lambda: [total("principal_disbursed").alias("total_principal_disbursed"),
                     total("total_expected_repayment").alias("total_expected_repayment"),
                     total("interest_charged").alias("total_interest_charged"),
                     total("principal_repaid").alias("total_principal_repaid")],
            as_of,
        ),
        "pos": Mart(
            lambda t: t.pos_txn, "transaction_date",
            lambda: [count_when(F.col("status_code") == "00").alias("success_volume"),
                     count_when(F.col("status_code") != "00").alias("failed_volume"),
                     sum_when(F.col("status_code") == "00", "amount").alias("success_value"),
                     sum_when(F.col("status_code") != "00", "amount").alias("failed_value")],
            as_of,
        ),
    }


def wallet_marts(as_of: DateLike) -> dict[str, Mart]:
    """Marts on wallet transactions. Test wallets and the terminal wallets are told apart in ``tables``."""
    terminal = lambda t: t.terminal_wallet_txn

    def flow(kind: str) -> Callable[[object], DataFrame]:
        return lambda t: t.kept_wallet_txn.filter(
            (F.col("transaction_response") == "00") & (F.col("transaction_type") == kind)
        )

    return {
        "terminal_wallet": Mart(terminal, "time", _volume_value, as_of),
        "terminal_wallet_status": Mart(
            terminal, "time",
            lambda: [count_when(F.col("transaction_response") == "00").alias("success_volume"),
                     count_when(F.col("transaction_response") != "00").alias("failed_volume"),
                     sum_when(F.col("transaction_response") == "00", "amount").alias("success_value"),
                     sum_when(F.col("transaction_response") != "00", "amount").alias("failed_value")],
            as_of,
        ),
        "wallet_outflow": Mart(flow("OUTFLOW"), "time", intra_inter_measures, as_of),
        "wallet_inflow": Mart(flow("INFLOW"), "time", intra_inter_measures, as_of),
        "wallet_loans": Mart(
            lambda t: t.wallet_txn.filter(
                (F.col("transaction_type") == "INITIAL INFLOW") & (F.col("transaction_response") == "00")
            ),
            "time", _volume_value, as_of,
        ),
    }


def api_marts(as_of: DateLike, excluded: Sequence[str], relabelled: Sequence[str]) -> dict[str, Mart]:
    """Marts on API calls and message charges."""
    return {
        "api_calls": Mart(
            lambda t: api_calls_kept(t.api_call, excluded, relabelled), "date",
            lambda: [F.count(F.lit(1)).alias("calls")], as_of, ("subscriber", "resource_consumed"),
        ),
        "message_charges": Mart(
            lambda t: t.api_call, "date",
            lambda: [F.count(F.lit(1)).alias("messages"), total("amount").alias("hold_amount")], as_of,
        ),
    }


def api_calls_kept(calls: DataFrame, excluded: Sequence[str], relabelled: Sequence[str]) -> DataFrame:
    """Calls of real subscribers that did not fail, with the account form of a resource told apart."""
    return calls.filter(
        ~F.col("subscriber").isin(*excluded) & ~F.col("response_status").isin(*FAILED_STATUS)
    ).withColumn("resource_consumed", suffix_resource(F.col("resource"), F.col("resource_value"), relabelled))


def intra_inter_measures() -> list[Column]:
    own = F.col("to_bank") == OWN_BANK
    return [
        count_when(own).alias("intra_volume"), count_when(~own).alias("inter_volume"),
        sum_when(own, "amount").alias("intra_value"), sum_when(~own, "amount").alias("inter_value"),
    ]


def gender_totals(clients: DataFrame) -> DataFrame:
    """Distinct clients per known gender, in lower case."""
    gender = F.lower(bands.decode("gender_code", bands.CLIENT_GENDER))
    return clients.withColumn("gender", gender).filter(F.col("gender").isNotNull()).groupBy("gender").agg(
        F.countDistinct("client_id").alias("customers")
    )


def distinct_buyers(purchases: DataFrame, owners: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct clients behind purchases. Purchases are made distinct by their key first, before they meet the owners."""
    return purchases.select(key).distinct().join(owners, key).agg(F.countDistinct("client_id").alias(name))


def cards_to_expire(cards: DataFrame, as_of: DateLike) -> DataFrame:
    return (
        cards.filter(bands.expires_in_year(F.col("expiry_code"), as_date(as_of)))
        .groupBy(F.col("expiry_code").cast("int").alias("expiry_date"))
        .agg(F.count(F.lit(1)).alias("cards_to_expire"))
    )


def loan_daily_spine(
    loans: DataFrame, schedule: DataFrame, payments: DataFrame, start: DateLike, as_of: DateLike
) -> DataFrame:
    """Disbursed, expected and repaid amounts of every day from ``start`` to the day before ``as_of``; 0 where none."""
    spark = loans.sparkSession
    in_span = lambda c: (F.col(c) >= day(start)) & (F.col(c) < day(as_of))
    disbursed = loans.filter(in_span("disbursedon_date")).groupBy(F.to_date("disbursedon_date").alias("date")).agg(
        F.sum("principal_disbursed").alias("total_disbursed")
    )
    expected = schedule.filter(in_span("duedate")).groupBy(F.col("duedate").alias("date")).agg(
        F.sum(F.col("principal_amount") + F.col("interest_amount")).alias("expected_repayment")
    )
    actual = payments.filter(in_span("transaction_date")).groupBy(F.col("transaction_date").alias("date")).agg(
        F.sum("amount").alias("actual_repayment")
    )
    zero = F.lit(0).cast("decimal(28,2)")
    return (
        date_spine(spark, start, as_date(as_of))
        .filter(F.col("date") < day(as_of))
        .join(disbursed, "date", "left")
        .join(expected, "date", "left")
        .join(actual, "date", "left")
        .select(
            "date",
            *[F.coalesce(c, zero).alias(c) for c in ("total_disbursed", "expected_repayment", "actual_repayment")],
        )
    )
