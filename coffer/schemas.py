"""Declared schemas of the conformed entities, checked at read by ``sources.readers.conform``."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 2)
_LONG, _INT, _TEXT, _DATE, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CLIENT = _schema(
    client_id=_LONG, client_name=_TEXT, client_category=_TEXT, client_tier=_TEXT, client_status=_TEXT,
    activation_date=_DATE, closedon_date=_DATE, referred_by_id=_LONG, mobile_number=_TEXT,
    daily_withdraw_limit=_MONEY, max_transaction_limit=_MONEY,
)
ACCOUNT = _schema(
    account_id=_LONG, client_id=_LONG, account_no=_TEXT, product_id=_INT, product_name=_TEXT, approvedon_date=_DATE,
    closedon_date=_DATE, balance=_MONEY,
)
TRANSACTION = _schema(
    transaction_id=_LONG, client_id=_LONG, account_id=_LONG, account_no=_TEXT, product_name=_TEXT, amount=_MONEY,
    transaction_date=_TS, type_enum=_INT, transaction_type=_TEXT, channel=_TEXT, response_code=_TEXT, partners=_TEXT,
    is_reversed=_TEXT, remarks=_TEXT, session_id=_TEXT,
)
WALLET_TRANSACTION = _schema(
    transaction_id=_LONG, wallet_name=_TEXT, transaction_type=_TEXT, from_account_no=_TEXT, to_account_no=_TEXT,
    to_bank=_TEXT, amount=_MONEY, transaction_response=_TEXT, statement_ids=_TEXT, time=_TS, session_id=_TEXT,
)
API_CALL = _schema(
    id=_LONG, subscriber=_TEXT, resource=_TEXT, resource_value=_TEXT, response_status=_TEXT, date=_TS, amount=_MONEY,
)
LOAN = _schema(
    loan_id=_LONG, client_id=_LONG, product_id=_INT, loan_status_id=_INT, principal_disbursed=_MONEY,
    principal_repaid=_MONEY, interest_charged=_MONEY, total_expected_repayment=_MONEY, disbursedon_date=_TS,
    closedon_date=_DATE,
)
SCHEDULE = _schema(loan_id=_LONG, duedate=_DATE, principal_amount=_MONEY, interest_amount=_MONEY)
PAYMENT = _schema(loan_id=_LONG, transaction_date=_DATE, amount=_MONEY)
TERM_DEPOSIT = _schema(
    account_id=_LONG, client_id=_LONG, account_no=_TEXT, balance=_MONEY, deposit_period=_INT, deposit_amount=_MONEY,
    maturity_amount=_MONEY, start_date=_DATE, maturity_date=_DATE,
)
CARD = _schema(card_id=_LONG, client_id=_LONG, pan_type=_TEXT, card_status=_TEXT, expiry_code=_TEXT, date_created=_DATE)
JOURNAL = _schema(
    entry_id=_LONG, transaction_id=_LONG, gl_account_id=_INT, type_enum=_INT, amount=_MONEY, entry_date=_DATE,
    classification_enum=_INT,
)
