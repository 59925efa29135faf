"""What proves each flag of the adoption matrix, on the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def adoption_evidence(t) -> dict[str, tuple[DataFrame, Column | None]]:
    txn, account, loan = t.transaction, t.account, t.loan
    cards = t.card.filter(F.col("card_status") == "ACTIVE")
    channel = lambda c: (txn, F.col("channel") == c)
    partner = lambda c: (txn, F.col("partners") == c)
    product = lambda c: (account, F.col("product_name") == c)
    return {
        "uses_mobile": channel("MOBILE"), "uses_ussd": channel("USSD"), "uses_chatbot": channel("CHATBOT"),
        "uses_wallet": channel("WALLET"),
        "pays_bills": partner("BILLS"), "buys_airtime_data": partner("VOUCHER"), "does_cardless": partner("CARDLESS"),
        "does_interbank_outflow": partner("NIPCREDIT"),
        "has_card": (cards, None),
        "has_usa": product("Universal Savings Account"), "has_fd": product("Term Fixed Deposit"),
        "has_target_savings": product("Target Savings Account"), "has_child_savings": product("Child Savings"),
        "has_corp_current": product("Corporate Current Account"), "has_indv_current": product("Individual Current Account"),
        "has_staff_current": product("Staff Current Account"),
        "has_credit": (loan, F.col("loan_status_id") == 300),
    }
