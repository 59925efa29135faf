"""The views of ``coffer.plans.views`` as DuckDB SQL."""

from __future__ import annotations

from coffer.plans.views import MERCHANT_CODES

PRODUCT_ID = "CASE {a} % 7 WHEN 0 THEN 33 WHEN 1 THEN 36 WHEN 2 THEN 26 WHEN 3 THEN 24 WHEN 4 THEN 30 WHEN 5 THEN 29 ELSE 31 END"
PRODUCT_NAME = (
    "CASE {a} % 7 WHEN 0 THEN 'Universal Savings Account' WHEN 1 THEN 'Term Fixed Deposit' "
    "WHEN 2 THEN 'Corporate Current Account' WHEN 3 THEN 'Child Savings' WHEN 4 THEN 'Target Savings Account' "
    "WHEN 5 THEN 'Individual Current Account' ELSE 'Staff Current Account' END"
)

_CODES = ", ".join(f"'{c}'" for c in MERCHANT_CODES)
_N_CODES = len(MERCHANT_CODES)

# name -> (views it reads, select text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "client": ((), """
SELECT c_custkey AS client_id, c_name AS client_name, c_mktsegment AS client_category,
  'Tier ' || (1 + c_custkey % 3) AS client_tier,
  CAST(99 + c_custkey % 3 AS VARCHAR) AS level_code,
  CASE WHEN c_custkey % 20 = 0 THEN '600' ELSE '300' END AS status_code,
  CASE WHEN c_custkey % 20 = 0 THEN 'Closed' ELSE 'Active' END AS client_status,
  CASE WHEN c_custkey % 13 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '29' ELSE '30' END END AS gender_code,
  CAST(64 + c_custkey % 3 AS VARCHAR) AS type_code,
  CAST(60 + c_custkey % 5 AS VARCHAR) AS marital_code,
  DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS activation_date,
  CASE WHEN c_custkey % 20 = 0 THEN DATE '1996-01-01' + CAST(c_custkey % 1500 AS INTEGER) END AS closedon_date,
  CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 50 END AS referred_by_id,
  CASE WHEN c_custkey % 11 <> 0 THEN '01-01-' || (1940 + c_custkey % 80) END AS dob_text,
  CASE WHEN c_custkey % 5 <> 0 THEN c_custkey + 1 END AS image_id,
  CASE WHEN c_custkey % 3 <> 0 THEN 31 ELSE 7 END AS activatedon_userid,
  CAST(50000 * (1 + c_custkey % 3) AS DECIMAL(18,2)) AS daily_withdraw_limit,
  CAST(20000 * (1 + c_custkey % 5) AS DECIMAL(18,2)) AS max_transaction_limit,
  CASE c_custkey % 4 WHEN 1 THEN 'WhatsApp' WHEN 2 THEN 'Backend' ELSE 'MobileApp' END AS onboard_channel,
  '080' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS mobile_number,
  CAST(c_acctbal AS DECIMAL(18,2)) AS net_position, c_nationkey AS state_id
FROM customer"""),
    "state": ((), "SELECT n_nationkey AS state_id, n_name AS state FROM nation"),
    "account": ((), f"""
SELECT account_id, client_id, '10' || lpad(CAST(account_id AS VARCHAR), 8, '0') AS account_no,
  {PRODUCT_ID.format(a='account_id')} AS product_id, {PRODUCT_NAME.format(a='account_id')} AS product_name,
  DATE '1994-01-01' + CAST(client_id % 365 + 30 * slot AS INTEGER) AS approvedon_date,
  CASE WHEN account_id % 9 = 0 THEN DATE '2000-06-01' + CAST(account_id % 400 AS INTEGER) END AS closedon_date,
  CASE WHEN account_id % 5 = 0 THEN 7 ELSE 31 END AS submittedby_userid,
  CAST(c_acctbal - 2000 * slot AS DECIMAL(18,2)) AS balance,
  CAST(5000 + 1000 * (account_id % 5) AS DECIMAL(18,2)) AS overdraft_limit,
  CASE WHEN account_id % 3 = 0 THEN DATE '2001-08-02' - CAST(account_id % 200 AS INTEGER) END AS overdraft_start,
  CASE WHEN account_id % 3 = 0 THEN DATE '2001-08-02' + CAST(account_id % 100 AS INTEGER) - 5 END AS overdraft_end,
  CASE WHEN account_id % 10 = 9 THEN 9000000 + c_nationkey END AS group_id
FROM (SELECT c_custkey * 2 + slot AS account_id, c_custkey AS client_id, slot, c_acctbal, c_nationkey
      FROM customer, (VALUES (0), (1)) AS s(slot))"""),
    "product": ((), """
SELECT * FROM (VALUES (33, 'Universal Savings Account'), (36, 'Term Fixed Deposit'), (30, 'Target Savings Account'),
 (24, 'Child Savings'), (26, 'Corporate Current Account'), (29, 'Individual Current Account'),
 (31, 'Staff Current Account')) AS t(product_id, product_name)"""),
    "txn": ((), f"""
SELECT k AS transaction_id, cust AS client_id, account_id,
  '10' || lpad(CAST(account_id AS VARCHAR), 8, '0') AS account_no,
  {PRODUCT_ID.format(a='account_id')} AS product_id, {PRODUCT_NAME.format(a='account_id')} AS product_name,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS transaction_date,
  CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS type_enum,
  CASE WHEN o_orderstatus = 'F' THEN 'withdrawal' ELSE 'deposit' END AS transaction_type,
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'MOBILE' WHEN '2' THEN 'USSD' WHEN '3' THEN 'CHATBOT' WHEN '4' THEN 'WALLET' END AS channel,
  CASE WHEN k % 7 = 0 THEN '91' ELSE '00' END AS response_code,
  CASE k % 6 WHEN 0 THEN 'INTERNAL' WHEN 1 THEN 'NIPCREDIT' WHEN 2 THEN 'CARDLESS' WHEN 3 THEN 'VOUCHER' WHEN 4 THEN 'BILLS' ELSE 'TRANSFER' END AS partners,
  CASE WHEN k % 6 = 0 THEN 'Internal transfer' ELSE 'External transfer' END AS partners_description,
  CASE WHEN k % 25 = 0 THEN 'Yes' ELSE 'No' END AS is_reversed,
  CASE k % 8 WHEN 0 THEN 'FD Booking' WHEN 1 THEN 'Roll over' WHEN 2 THEN 'Loan Disbursement' WHEN 3 THEN 'Partial Liquidation'
    WHEN 4 THEN 'Reversal Of transactionId ' || (k - 1) ELSE 'Transfer to ' || (cust % 100) END AS remarks,
  CASE WHEN k % 6 = 3 THEN 'VOUCHER|item ' || (k % 5) || CASE WHEN k % 2 = 0 THEN '|429' ELSE '|133' END END AS third_party_name,
  CASE WHEN k % 3 <> 0 THEN 'S' || k END AS session_id
FROM (SELECT *, o_orderkey AS k, o_custkey AS cust, o_custkey * 2 + o_orderkey % 2 AS account_id FROM orders)"""),
    "txn_bal": (("txn",), """
SELECT *, CAST(sum(CASE WHEN type_enum = 1 THEN amount ELSE -amount END)
  OVER (PARTITION BY account_id ORDER BY transaction_date, transaction_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS running_balance
FROM txn"""),
    "bill": ((), """
SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS transaction_id, l_orderkey AS order_id, l_suppkey AS biller_id, l_partkey AS item_id,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS settled_amount,
  l_shipdate AS transaction_date,
  CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'success' END AS transaction_status,
  CASE l_linenumber % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'USSD' WHEN 2 THEN 'CHATBOT' ELSE 'WALLET' END AS channel,
  s_name AS biller
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey"""),
    "bill_client": (("bill",), "SELECT bill.*, o_custkey AS client_id FROM bill LEFT JOIN orders ON o_orderkey = order_id"),
    "bill_item": (("bill",), """
SELECT bill.*, CASE WHEN p_type = 'SMALL' THEN 'Blank' ELSE upper(p_name) END AS biller_code,
  p_type || ' ' || p_name || ' ' || p_brand AS remarks
FROM bill LEFT JOIN part ON p_partkey = item_id"""),
    "bill_only": (("bill_item",), "SELECT * FROM bill_item WHERE NOT (coalesce(biller_code, '') LIKE '%RED%' OR coalesce(biller_code, '') LIKE '%BLUE%')"),
    "branded_item": (("bill_item",), f"""
SELECT * REPLACE (([{_CODES}])[CAST(item_id % {_N_CODES} AS INTEGER) + 1] AS biller_code) FROM bill_item"""),
    "wallet": ((), """
SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS transaction_id, l_orderkey AS order_id, l_suppkey AS wallet_id,
  CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 'INITIAL INFLOW' WHEN l_linestatus = 'O' THEN 'OUTFLOW' ELSE 'INFLOW' END AS transaction_type,
  '20' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 8, '0') AS from_account_no,
  '20' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS to_account_no,
  CAST(l_partkey % 25 AS INTEGER) AS from_bank,
  CASE WHEN l_suppkey % 2 = 0 THEN '999999' ELSE '000013' END AS to_bank,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CASE WHEN l_returnflag = 'R' THEN '99' ELSE '00' END AS transaction_response,
  l_orderkey || '-' || l_linenumber AS statement_ids, l_shipdate AS time, 'S' || l_orderkey AS session_id, s_name AS wallet_name,
  l_orderkey * 10 + l_linenumber AS pooled_id
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey"""),
    "bank": ((), "SELECT n_nationkey AS bank_code, 'BANK ' || n_name AS bank_name FROM nation"),
    "pos": ((), """
SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS transaction_id, l_orderkey AS order_id, l_suppkey AS merchant_id,
  'T' || lpad(CAST(l_suppkey % 500 AS VARCHAR), 6, '0') AS terminal_id,
  CASE WHEN l_returnflag = 'R' THEN '51' ELSE '00' END AS status_code,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS settled_amount,
  '506101' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS card_pan, l_shipdate AS transaction_date
FROM lineitem"""),
    "api": ((), """
SELECT event_id AS id, 'user-' || user_id AS subscriber, '/' || event_type AS resource,
  CASE WHEN event_id % 4 = 0 THEN 'acct/' || event_id ELSE props END AS resource_value,
  CASE WHEN event_type = 'error' THEN 'Fail' ELSE 'Success' END AS response_status, ts AS date,
  CAST(value AS DECIMAL(18,2)) AS amount
FROM events"""),
    "loan": ((), """
SELECT o_orderkey AS loan_id, o_custkey AS client_id, CAST(o_orderkey % 4 AS INTEGER) AS product_id,
  CASE WHEN o_orderstatus = 'F' THEN 600 ELSE 300 END AS loan_status_id,
  CAST(o_totalprice AS DECIMAL(18,2)) AS principal_disbursed,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS principal_repaid,
  CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS interest_charged,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS total_expected_repayment,
  o_orderdate AS disbursedon_date,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 180 END AS closedon_date,
  CAST(o_orderkey % 5 AS INTEGER) AS purpose_id, CAST(o_orderkey % 3 + 10 AS INTEGER) AS collateral_id,
  CAST(o_orderkey % 7 AS INTEGER) AS officer_id, CAST(o_orderkey % 5 + 2 AS INTEGER) AS approver_id
FROM orders WHERE o_orderpriority = '1-URGENT'"""),
    "schedule": (("loan",), """
SELECT l_orderkey AS loan_id, CAST(l_shipdate AS DATE) AS duedate, CAST(l_extendedprice AS DECIMAL(18,2)) AS principal_amount,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS interest_amount, l_returnflag AS flag
FROM lineitem WHERE l_orderkey IN (SELECT loan_id FROM loan)"""),
    "payment": (("schedule",), "SELECT loan_id, duedate AS transaction_date, principal_amount AS amount FROM schedule WHERE flag = 'R'"),
    "code_value": ((), """
SELECT * FROM (VALUES ('status', 300, 'Active'), ('status', 600, 'Closed'), ('purpose', 0, 'Rent'), ('purpose', 1, 'School'),
 ('purpose', 2, 'Trade'), ('purpose', 3, 'Health'), ('collateral', 10, 'None'), ('collateral', 11, 'Vehicle'),
 ('collateral', 12, 'Property'), ('product', 0, 'Salary loan'), ('product', 1, 'Trade loan'), ('product', 2, 'Overdraft'),
 ('product', 3, 'Asset loan')) AS t(code_name, code_id, label)"""),
    "staff_user": ((), """
SELECT * FROM (VALUES (0, 'u.zero'), (1, 'u.one'), (2, 'u.two'), (3, 'u.three'), (4, 'u.four'), (5, 'u.five')) AS t(user_id, username)"""),
    "term_deposit": (("account",), """
SELECT account_id, client_id, account_no, balance, CAST(30 * (1 + account_id % 12) AS INTEGER) AS deposit_period,
  CAST(abs(balance) AS DECIMAL(18,2)) AS deposit_amount,
  CAST(round(CAST(abs(balance) AS DECIMAL(18,2)) * CAST(1.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS maturity_amount,
  approvedon_date + 2557 AS start_date, approvedon_date + 2557 + CAST(30 * (1 + account_id % 12) AS INTEGER) AS maturity_date
FROM account WHERE product_id = 36"""),
    "card": ((), """
SELECT c_custkey AS card_id, c_custkey AS client_id, CASE WHEN c_custkey % 3 = 0 THEN 'PHYSICAL' ELSE 'VIRTUAL' END AS pan_type,
  CASE c_custkey % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'EXPIRED' ELSE 'BLOCKED' END AS card_status,
  lpad(CAST(94 + c_custkey % 6 AS VARCHAR), 2, '0') || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') AS expiry_code,
  DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS date_created, 2 * c_custkey AS account_id,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST(500 * (1 + c_custkey % 4) AS DECIMAL(18,2)) END AS charge
FROM customer"""),
    "card_txn": ((), """
SELECT o_orderkey AS id, o_custkey AS client_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'cashWithdrawal' WHEN 1 THEN 'debitGoodsAndServices' WHEN 2 THEN 'paymentFromAccount' ELSE 'accountTransfer' END AS transaction_type,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS transaction_date,
  CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS transaction_status
FROM orders"""),
    "journal": ((), """
SELECT o_orderkey * 2 + leg AS entry_id, o_orderkey AS transaction_id, CAST((o_custkey % 10 + leg - 1) % 10 AS INTEGER) AS gl_account_id,
  leg AS type_enum, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS entry_date,
  CAST(1 + ((o_custkey % 10 + leg - 1) % 10) % 5 AS INTEGER) AS classification_enum
FROM orders, (VALUES (1), (2)) AS l(leg)"""),
    "gl_account": ((), "SELECT CAST(range AS INTEGER) AS gl_account_id, 'GL ' || range AS gl_name FROM range(10)"),
}


def with_views(names: str, body: str) -> str:
    """``body`` behind a WITH clause of the named views and what they read.

    A body that starts with ``WITH`` has its own CTEs appended to the list.
    """
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for inner in VIEWS[name][0]:
            visit(inner)
        order.append(name)

    for name in names.split():
        visit(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in order)
    text = body.strip()
    if not ctes:
        return text
    if text[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{text[5:]}"
    return f"WITH {ctes}\n{text}"
