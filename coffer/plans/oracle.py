"""The SQL each registered query is checked against, for DuckDB on the test tables.

Written from the meaning of the report, not from the Spark plan: plain joins, windows over whole keys and DuckDB's own
quantiles, where the operators take other ways round.
"""

from __future__ import annotations

from coffer.plans.oracle_views import with_views

ORACLE: dict[str, str] = {}


def sql(name: str, views: str, body: str, money: str = "", date: str = "", ts: str = "", whole: str = "") -> None:
    """Registers a query. The lists name columns to give in the types ``catalog.present`` gives."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
    casts += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in date.split()]
    casts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ts.split()]
    casts += [f"CAST({c} AS BIGINT) AS {c}" for c in whole.split()]
    if casts:
        body = body.strip()
        head = ""
        if body[:5].upper() == "WITH ":
            # own CTEs stay in front; the last SELECT is after the marker
            head, body = body.split("--main", 1)
        body = f"{head}SELECT * REPLACE ({', '.join(casts)}) FROM ({body.strip()})"
    else:
        body = body.replace("--main", "")
    ORACLE[name] = with_views(views, body)


def _percent(part: str, whole: str) -> str:
    """Two decimals, halves away from zero, in whole cents."""
    p, w = (f"CAST(CAST({x} AS DECIMAL(28,2)) * 100 AS HUGEINT)" for x in (part, whole))
    return f"sign({p}) * CAST((abs({p}) * 20000 + {w}) // ({w} * 2) AS DOUBLE) / 100"


# -- loads and repairs -------------------------------------------------------------------------------------------------

LOADED = "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'"
sql("incremental_high_water", "", f"""
SELECT * FROM events
WHERE event_id > (SELECT coalesce(max(event_id), 0) FROM ({LOADED}))""", ts="ts")
sql("incremental_high_water_default", "", """
SELECT * FROM events WHERE event_id > 0 AND ts > TIMESTAMP '2000-01-01'""", ts="ts")
sql("incremental_two_marks", "", f"""
SELECT * FROM events
WHERE event_id > (SELECT max(event_id) FROM ({LOADED})) AND ts > (SELECT max(ts) FROM ({LOADED}))""", ts="ts")
sql("incremental_min_watermark", "", f"""
SELECT * FROM events
WHERE event_id > least((SELECT max(event_id) FROM ({LOADED})), (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-12'))""", ts="ts")
sql("incremental_high_water_batch", "", f"""
SELECT * FROM events WHERE event_id > (SELECT max(event_id) FROM ({LOADED})) ORDER BY event_id LIMIT 500""", ts="ts")
sql("full_reload_snapshot", "loan client", """
SELECT loan_id, loan.client_id, client_name, principal_disbursed, disbursedon_date, DATE '2001-08-02' AS load_date
FROM loan LEFT JOIN client ON client.client_id = loan.client_id""", money="principal_disbursed", date="load_date", ts="disbursedon_date")
sql("id_range_batches", "txn", """
SELECT (transaction_id - 100) // 3000 AS batch, count(*) AS rows, min(transaction_id) AS first_id, max(transaction_id) AS last_id, sum(amount) AS amount
FROM txn WHERE transaction_id >= 100 GROUP BY 1""", money="amount")
sql("statement_10min_slices", "api", """
SELECT time_bucket(INTERVAL '10 minutes', date, TIMESTAMP '2024-01-01') AS slice_start, resource, count(*) AS lines, sum(amount) AS amount
FROM api GROUP BY 1, 2""", money="amount", ts="slice_start")
sql("missing_keys_anti", "", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag <> 'R')""")
sql("dedupe_exact_rows", "", "SELECT DISTINCT * FROM lineitem", ts="l_shipdate", whole="l_linenumber")
sql("repeats_repaired_in_place", "", "SELECT *, CAST(ts AS DATE) AS day FROM events", date="day", ts="ts")
sql("reconcile_by_ranges", "", """
WITH source AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 <> 7),
target AS (SELECT l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag <> 'R' OR l_orderkey > 4000)
--main SELECT *, 'missing' AS side FROM (SELECT o_orderkey FROM source EXCEPT SELECT o_orderkey FROM target)
UNION ALL SELECT *, 'surplus' FROM (SELECT o_orderkey FROM target EXCEPT SELECT o_orderkey FROM source)""")
sql("duplicate_keys_report", "", """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""", whole="l_linenumber")
sql("dedupe_by_key", "", """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
    l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS n FROM lineitem)
WHERE n = 1""", ts="l_shipdate", whole="l_linenumber")
for _name, _width in (("truncate_strings", 256), ("truncate_long_text", 65000)):
    sql(_name, "", f"SELECT *, left(text, {_width}) AS text_clipped, length(text) > {_width} AS text_was_cut FROM documents")
sql("normalize_columns", "", "SELECT c_custkey AS client_id, c_name AS client_name, c_mktsegment AS client_category FROM customer")

sql("append_load", "", "SELECT * FROM events", ts="ts")
sql("saved_table", "account", "SELECT product_id, product_name, count(*) AS accounts FROM account GROUP BY 1, 2", whole="product_id")
sql("staged_tables", "", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {n}" for n in ("region", "nation", "customer", "events")))
sql("csv_file", "client", "SELECT client_id, client_name, client_tier, referred_by_id FROM client")
sql("reference_list_join", "client", """
SELECT c.client_id, s.client_id AS staff_id, s.client_name AS staff_name FROM client c JOIN client s ON s.client_id = c.referred_by_id""")

# -- codes, classes, text ----------------------------------------------------------------------------------------------

LABELS = """
  trim(replace(client_name, 'null', '')) AS client_name,
  CASE status_code WHEN '0' THEN 'Invalid' WHEN '100' THEN 'Pending' WHEN '300' THEN 'Active' WHEN '600' THEN 'Closed' END AS client_status,
  CASE gender_code WHEN '29' THEN 'Male' WHEN '30' THEN 'Female' END AS client_gender,
  CASE type_code WHEN '64' THEN 'Personal' WHEN '65' THEN 'Official' WHEN '66' THEN 'Business' END AS client_type,
  CASE marital_code WHEN '61' THEN 'Single' WHEN '62' THEN 'Married' WHEN '63' THEN 'Divorcee' END AS marital_status,
  CASE level_code WHEN '99' THEN 'Tier 1' WHEN '100' THEN 'Tier 2' WHEN '101' THEN 'Tier 3' END AS client_tier"""
sql("decode_enum_labels", "client", f"SELECT client_id, {LABELS} FROM client")
CATEGORY = """
SELECT client_id, coalesce(image_id, 0) AS image_id,
  CASE WHEN image_id IS NOT NULL THEN 1 ELSE 0 END AS is_appclient,
  CASE WHEN client_id IN (SELECT s_suppkey FROM supplier) THEN 1 ELSE 0 END AS is_walletclient,
  CASE WHEN client_id IN (SELECT client_id FROM account WHERE product_id = 26) THEN 1 ELSE 0 END AS is_corpclient,
  CASE WHEN image_id IS NOT NULL THEN 'Retail client'
    WHEN client_id IN (SELECT s_suppkey FROM supplier) THEN 'Wallet client'
    WHEN client_id IN (SELECT client_id FROM account WHERE product_id = 26) THEN 'Corporate client'
    ELSE 'Unclassified' END AS client_category
FROM client"""
sql("client_category", "client account", CATEGORY, whole="is_appclient is_walletclient is_corpclient")
WALLET_ACCOUNTS = "SELECT '10' || lpad(CAST(s_suppkey * 3 AS VARCHAR), 8, '0') FROM supplier"
sql("account_type_classify", "account client", f"""
SELECT account_no, client_id, product_id,
  CASE WHEN account_no IN ({WALLET_ACCOUNTS}) AND product_id = 26 THEN 'wallet-corporate'
    WHEN product_id = 26 THEN 'pure-corporate'
    WHEN client_id IN (SELECT client_id FROM client WHERE image_id IS NOT NULL) AND product_id IN (24,26,29,30,31,32,33) THEN 'standard retail'
    WHEN product_id NOT IN (24,26,29,30,31,32,33,36) THEN 'wallet retail' ELSE 'others' END AS account_type
FROM account""", whole="product_id")
COHORT = """CASE WHEN dob_text IS NULL THEN 'Not Found' WHEN right(dob_text, 4) < '1945' THEN 'Silent Generation'
  WHEN right(dob_text, 4) BETWEEN '1946' AND '1964' THEN 'Baby Boomers' WHEN right(dob_text, 4) BETWEEN '1965' AND '1979' THEN 'Generation X'
  WHEN right(dob_text, 4) BETWEEN '1980' AND '1994' THEN 'Millennials' WHEN right(dob_text, 4) BETWEEN '1995' AND '2012' THEN 'Generation Z'
  WHEN right(dob_text, 4) > '2012' THEN 'Generation Alpha' END"""
sql("generation_cohort", "client", f"SELECT {COHORT} AS generation, count(*) AS clients FROM client WHERE client_status <> 'Closed' GROUP BY 1")
RISK = "(SELECT c_custkey AS client_id, CAST((c_custkey % 10 + 1) AS DOUBLE) / 2 AS risk_score FROM customer WHERE c_mktsegment <> 'FURNITURE')"
BAND = "CASE WHEN risk_score <= 1.5 THEN 'Low risk' WHEN risk_score < 4 THEN 'Medium risk' WHEN risk_score >= 4 THEN 'High risk' END"
sql("aml_risk_band", "client", f"""
SELECT client.client_id, risk_score, {BAND} AS aml_risk_rating FROM client LEFT JOIN {RISK} r ON r.client_id = client.client_id""")
MATURITY = "CASE WHEN {d} - DATE '2001-08-02' > 60 THEN 'above 60 days' WHEN {d} - DATE '2001-08-02' >= 31 THEN 'btw 31-60 days' WHEN {d} - DATE '2001-08-02' < 31 THEN '30 days and below' END"
sql("maturity_band", "account", f"""
SELECT {MATURITY.format(d='overdraft_end')} AS band, count(*) AS accounts, sum(overdraft_limit) AS limit_total
FROM account WHERE overdraft_end IS NOT NULL GROUP BY 1""", money="limit_total")
sql("coalesce_valid_account", "", """
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 2 THEN CAST(s_suppkey AS VARCHAR) WHEN s_suppkey % 5 = 0 THEN NULL ELSE '20' || s_suppkey END AS account_no
FROM supplier""")
LARGE = """type_enum IN (1, 2) AND is_reversed = 'No' AND product_id IN (29, 33)
  AND remarks NOT ILIKE '%FD Book%' AND remarks NOT ILIKE '%Roll over%' AND remarks NOT ILIKE '%Loan Disbu%' AND remarks NOT ILIKE '%Partial Liquid%'"""
sql("large_txn_filter", "txn", f"""
SELECT transaction_id, client_id, amount, product_id, remarks, transaction_date FROM txn WHERE {LARGE} AND amount >= 200000""",
    money="amount", ts="transaction_date", whole="product_id")
sql("string_features", "", """
SELECT c_custkey, left(c_name, 8) AS head, right(c_name, 4) AS tail, substring(c_name, 3, 5) AS middle, upper(c_name) AS upper_name,
  lower(c_mktsegment) AS segment, CAST(length(c_name) AS BIGINT) AS name_length, trim('  ' || c_name || ' ') AS trimmed,
  replace(c_name, 'Customer#', 'C-') AS short_name,
  left(lpad(CAST(c_custkey AS VARCHAR), 16, '5'), 6) || '******' || right(lpad(CAST(c_custkey AS VARCHAR), 16, '5'), 4) AS masked_pan
FROM customer""")


# The marks of each biller, first match wins; written out here, so that a rule mistyped in the code is seen.
BILLER_MARKS = """
GOTV CABLE SERVICE: GOTV
BET9JA: BET 9JA, BET9JA
SPORTYBET: SPORTYBET, SPORTY BET
IKEJA ELECTRIC: IKEJA, IKEDC
DSTV CABLE SERVICE: DSTV
ABUJA ELECTRIC: ABUJA
EKO ELECTRIC: EKO, EKEDC
IBADAN ELECTRIC: IBADAN, IBEDC
BETKING: BETKING, BET KING
1XBET: 1XBET, 1X BET
STARTIMES CABLE SERVICE: STARTIMES, STAR TIMES
SMILE INTERNET SERVICE: SMILE
NAIRABET: NAIRABET
ENUGU ELECTRIC: ENUGU, EEDC
XBOX: XBOX
MERRYBET: MERRYBET, MERRY BET
SWIFT INTERNET SERVICE: SWIFT
BENIN ELECTRIC: BENIN, BEEDC
GOOGLE PLAY SERVICE: GOOGLE
BETWAY: BETWAY, BET WAY
IPNX: IPNX
SONY PLAYSTATION: SONY PLAYSTATION
AMAZON: AMAZON
SPOTIFY: SPOTIFY
BANGBET: BANGBET, BANG BET
PORTHARCOURT ELECTRIC: PORTHARCOURT, PHEDC, PEDC
KADUNA ELECTRIC: KADUNA
TSTV CABLE SERVICE: TSTV
ARIK AIRLINE: ARIK
KANO ELECTRIC: KANO
AXA MANSARD: AXA
NAIJABET: NAIJABET
WINNERS CHAPEL: WINNERS CHAPEL
SPECTRANET INTERNET SERVICE: SPECTRANET
MLOTTO BET: MLOTTO
WINNERS GOLDEN BET: WINNERS GOLDEN CHANCE, WGB
FLEXI INTERNET: FLEXI
"""


def _biller_case(code: str) -> str:
    """The ordered biller rules as one CASE."""
    arms = []
    for label, marks in (line.split(": ") for line in BILLER_MARKS.strip().splitlines()):
        arms.append("WHEN " + " OR ".join(f"contains(upper({code}), '{m}')" for m in marks.split(", ")) + f" THEN '{label}'")
    return "CASE " + " ".join(arms) + f" ELSE {code} END"


def _brand_case(code: str) -> str:
    return f"""CASE WHEN upper({code}) LIKE '%MTN%' THEN 'MTN' WHEN upper({code}) LIKE '%AIRTEL%' THEN 'AIRTEL'
  WHEN upper({code}) LIKE '%GLO%' THEN 'GLO' WHEN upper({code}) LIKE '%9MOBILE%' THEN '9MOBILE' END"""


CODE = "CASE WHEN biller_code IS NULL OR biller_code = 'Blank' THEN remarks ELSE biller_code END"
sql("biller_categorise", "branded_item", f"""
SELECT {_biller_case('code')} AS biller_by_rule, count(*) AS purchases, sum(amount) AS amount
FROM (SELECT {CODE} AS code, amount FROM branded_item) GROUP BY 1""", money="amount")
sql("voucher_name_clean", "txn", """
SELECT replace(replace(replace(third_party_name, 'VOUCHER|', ''), '|429', ''), '|133', '') AS voucher, count(*) AS volume
FROM txn WHERE third_party_name IS NOT NULL GROUP BY 1""")
sql("statement_id_head", "wallet txn_bal", """
SELECT wallet.transaction_id, wallet_name, statement_ids, wallet.amount, split_part(statement_ids, '-', 1) AS head_id, running_balance AS balance
FROM wallet LEFT JOIN txn_bal ON CAST(txn_bal.transaction_id AS VARCHAR) = split_part(statement_ids, '-', 1)
WHERE wallet.transaction_type = 'OUTFLOW'""", money="amount balance")
sql("explode_account_list", "", """
SELECT s_name, prefix || s_suppkey AS account_no FROM supplier, (VALUES ('1'), ('2'), ('3')) AS p(prefix)""")
sql("kpi_formatted", "wallet", """
SELECT wallet_name, format('{:,}', count(*)) AS volume, 'N' || format('{:,.2f}', CAST(sum(amount) AS DOUBLE)) AS value,
  format('{:,.2f}', count(*) / 4) || '%' AS percent FROM wallet GROUP BY 1""")
sql("calendar_spine", "txn", """
SELECT strftime(d.date, '%Y-%m-%d') AS date, strftime(d.date, '%Y-%m') AS month, year(d.date) AS year,
  strftime(last_day(d.date), '%Y-%m-%d') AS month_end, d.date = last_day(d.date) AS is_month_end,
  coalesce(n, 0) AS transactions
FROM (SELECT CAST(range AS DATE) AS date FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-03', INTERVAL '1 day')) d
LEFT JOIN (SELECT CAST(transaction_date AS DATE) AS date, count(*) AS n FROM txn GROUP BY 1) a ON a.date = d.date""")
sql("business_day_rollback", "api", """
WITH days AS (SELECT CAST(range AS DATE) AS d FROM range(TIMESTAMP '2023-12-20', TIMESTAMP '2024-02-01', INTERVAL '1 day')),
open_days AS (SELECT d FROM days WHERE isodow(d) < 6 AND d NOT IN (DATE '2024-01-01', DATE '2024-01-26'))
--main SELECT date, calls, (SELECT max(o.d) FROM open_days o WHERE o.d < c.date) AS previous_business_day
FROM (SELECT CAST(date AS DATE) AS date, count(*) AS calls FROM api GROUP BY 1) c""", date="date previous_business_day")

# -- joins -------------------------------------------------------------------------------------------------------------

TRANSFER = """(SELECT o_orderkey AS from_txn, CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey ELSE o_orderkey + 1 END AS to_txn,
  o_orderkey AS transfer_id, o_orderdate AS transfer_date,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Deposit LIQUIDATION' ELSE 'Account transfer' END AS description FROM orders)"""
TWO_LEGS = f"""
SELECT tr.transfer_date, rt.account_no AS receiver_account_no, rt.client_id AS receiver_client_id, rc.client_name AS receiver_name,
  rt.running_balance AS receiver_balance, st.amount AS amount, 'OWN BANK' AS receiver_bank, st.account_no AS sender_account_no,
  st.client_id AS sender_client_id, sc.client_name AS sender_name, st.running_balance AS sender_balance, tr.from_txn AS resource_id,
  'OWN BANK' AS sender_bank, tr.description AS narration
FROM {TRANSFER} tr JOIN txn_bal st ON st.transaction_id = tr.from_txn JOIN client sc ON sc.client_id = st.client_id
JOIN txn_bal rt ON rt.transaction_id = tr.to_txn JOIN client rc ON rc.client_id = rt.client_id"""
sql("transfer_two_legs", "txn_bal client", TWO_LEGS, money="receiver_balance amount sender_balance", ts="transfer_date")
sql("pos_sweep_transfers", "txn_bal client account",
    f"{TWO_LEGS} WHERE st.account_no IN (SELECT account_no FROM account WHERE product_id = 26)",
    money="receiver_balance amount sender_balance", ts="transfer_date")
sql("audit_user_accounts", "account client staff_user", """
WITH audit AS (SELECT o_orderkey AS audit_id, CAST(o_orderkey % 7 AS INTEGER) AS maker_id,
  'account=10' || lpad(CAST(o_custkey * 2 + o_orderkey % 2 AS VARCHAR), 8, '0') || ';transit=10' || lpad(CAST(o_custkey * 2 + o_orderkey % 2 + 1 AS VARCHAR), 8, '0') AS resource
  FROM orders),
owner AS (SELECT account_no, client_name FROM account JOIN client ON client.client_id = account.client_id)
--main SELECT audit_id, maker_id, resource, username, trim(substring(resource, 9, 10)) AS main_account_no, m.client_name AS main_account_name,
  trim(substring(resource, 28, 10)) AS transit_account_no, t.client_name AS transit_account_name
FROM audit LEFT JOIN staff_user ON user_id = maker_id
LEFT JOIN owner m ON m.account_no = trim(substring(resource, 9, 10))
LEFT JOIN owner t ON t.account_no = trim(substring(resource, 28, 10))""", whole="maker_id")
sql("transactions_enriched", "txn account client", """
SELECT transaction_id, txn.client_id,
  CASE WHEN account.group_id IS NULL THEN client_name ELSE n_name END AS owner_name,
  txn.account_no, txn.product_name, amount, transaction_date, is_reversed, transaction_type,
  CASE WHEN partners <> 'INTERNAL' THEN channel END AS settled_channel,
  CASE WHEN partners <> 'INTERNAL' THEN response_code END AS settled_response
FROM txn LEFT JOIN account ON account.account_id = txn.account_id LEFT JOIN client ON client.client_id = account.client_id
LEFT JOIN nation ON 9000000 + n_nationkey = account.group_id""", money="amount", ts="transaction_date")
AIRTIME = "(SELECT * FROM bill_item WHERE biller_code LIKE '%RED%' OR biller_code LIKE '%BLUE%')"
sql("bills_not_airtime", "bill_item", f"""
SELECT biller, count(*) AS bills, sum(amount) AS amount FROM bill_item
WHERE transaction_id NOT IN (SELECT transaction_id FROM {AIRTIME}) GROUP BY 1""", money="amount")
sql("referrer_self_join", "client", """
SELECT c.client_id, c.client_name, c.referred_by_id, r.client_name AS referrer_name
FROM client c LEFT JOIN client r ON r.client_id = c.referred_by_id""")
LEGS = "(SELECT transaction_id AS leg_id, product_name, amount FROM txn WHERE product_id IN (36, 30) AND type_enum = 2)"
sql("liquidation_or_join", "txn", f"""
SELECT tr.*, l.* FROM {TRANSFER} tr JOIN {LEGS} l ON l.leg_id = tr.to_txn OR l.leg_id = tr.from_txn
WHERE description ILIKE '%liq%'""", money="amount", ts="transfer_date")
sql("gl_entry_description", "journal gl_account txn client", """
SELECT entry_id, coalesce(gl_name || '-(' || account_no || '-' || client_name || ')', gl_name) AS account_name, remarks AS description
FROM journal j LEFT JOIN gl_account g ON g.gl_account_id = j.gl_account_id
LEFT JOIN txn ON txn.transaction_id = j.transaction_id LEFT JOIN client ON client.client_id = txn.client_id""")
for _name, _limit in (("call_over_lookup", ""), ("call_over_of_day", "WHERE m.username = 'u.two' AND CAST(made_on AS DATE) = DATE '1998-07-06'")):
    sql(_name, "account txn staff_user", f"""
WITH cmd AS (SELECT o_orderkey AS command_id, o_orderkey AS resource_id, o_orderkey % 6 AS maker_id, o_orderkey % 8 AS checker_id, o_custkey * 2 AS account_id,
  o_orderdate AS made_on FROM orders)
--main SELECT command_id, resource_id, m.username AS maker,
  (SELECT username FROM staff_user c WHERE c.user_id = cmd.checker_id) AS checker,
  (SELECT account_no FROM account a WHERE a.account_id = cmd.account_id) AS account_no,
  (SELECT amount FROM txn t WHERE t.transaction_id = cmd.resource_id) AS amount,
  (SELECT remarks FROM txn t WHERE t.transaction_id = cmd.resource_id) AS narration
FROM cmd JOIN staff_user m ON m.user_id = cmd.maker_id {_limit}""", money="amount")
OWNER = """SELECT a.account_id, a.account_no, CASE WHEN group_id IS NULL THEN a.client_id ELSE group_id END AS owner_id,
  CASE WHEN group_id IS NULL THEN client_name ELSE n_name END AS owner_name
FROM account a LEFT JOIN client c ON c.client_id = a.client_id LEFT JOIN nation ON 9000000 + n_nationkey = group_id"""
sql("client_or_group", "account client", OWNER)
sql("transactions_of_listed_keys", "", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey IN (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND CAST(l_extendedprice AS DECIMAL(18,2)) > 30000)""", whole="l_linenumber")
sql("limit_increase", "client account txn", """
WITH old AS (SELECT client_id, daily_withdraw_limit - CASE WHEN client_id % 9 = 0 THEN 10000 ELSE 0 END AS d,
  max_transaction_limit - CASE WHEN client_id % 14 = 0 THEN 5000 ELSE 0 END AS m FROM client)
--main SELECT c.client_id, c.daily_withdraw_limit, old.d AS daily_limit_before, c.max_transaction_limit, old.m AS single_limit_before,
  client_name, client_tier, (SELECT min(account_no) FROM account a WHERE a.client_id = c.client_id) AS account_no,
  (SELECT max(CAST(transaction_date AS DATE)) FROM txn t WHERE t.client_id = c.client_id AND is_reversed = 'No') AS last_transaction_date
FROM client c JOIN old ON old.client_id = c.client_id WHERE c.daily_withdraw_limit > old.d OR c.max_transaction_limit > old.m""",
    money="daily_withdraw_limit daily_limit_before max_transaction_limit single_limit_before", date="last_transaction_date")
sql("onboarding_crossdb", "client", f"""
SELECT event_id AS application_id, e.user_id AS client_id, c.client_name, c.client_tier, ts AS created_on, risk_score, {BAND} AS risk_rating,
  rf.client_name AS referrer_name
FROM events e LEFT JOIN client c ON c.client_id = e.user_id LEFT JOIN {RISK} r ON r.client_id = e.user_id
LEFT JOIN client rf ON rf.client_id = c.referred_by_id WHERE event_type = 'signup'""", ts="created_on")
sql("left_join_on_filter", "client account", """
SELECT c.client_id, c.daily_withdraw_limit, nullif(count(a.account_id), 0) AS open_retail_accounts
FROM client c LEFT JOIN account a ON a.client_id = c.client_id AND a.product_id IN (29, 31, 33) AND a.closedon_date IS NULL
GROUP BY 1, 2""", money="daily_withdraw_limit")

# -- aggregates --------------------------------------------------------------------------------------------------------

sql("client_txn_summary", "txn", """
SELECT client_id, count(*) AS volume, sum(amount) AS value, min(amount) AS smallest, max(amount) AS largest,
  CAST(sum(amount) AS DOUBLE) / count(*) AS mean_amount FROM txn GROUP BY 1""", money="value smallest largest")
sql("distinct_customers", "txn", "SELECT coalesce(channel, 'none') AS channel, count(DISTINCT client_id) AS customers FROM txn GROUP BY 1")
sql("subaccount_last_txn", "account client txn_bal", """
WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY transaction_date DESC, transaction_id DESC) AS n FROM txn_bal) WHERE n = 1)
--main SELECT a.account_id, a.account_no, client_name, a.product_name, a.balance, CAST(last.transaction_date AS DATE) AS last_transaction_date,
  last.running_balance AS balance_at_last_transaction
FROM account a JOIN client ON client.client_id = a.client_id LEFT JOIN last ON last.account_id = a.account_id WHERE a.product_id = 33""",
    money="balance balance_at_last_transaction", date="last_transaction_date")
sql("avg_txn_per_customer", "txn", """
SELECT product_name, count(DISTINCT client_id) AS total_customers, count(*) // count(DISTINCT client_id) AS avg_transactions_per_customer
FROM txn GROUP BY 1""")
sql("gl_account_lines", "journal gl_account", """
SELECT DISTINCT j1.entry_id, j1.entry_date, gl_name, j1.transaction_id, CASE WHEN j1.type_enum = 1 THEN j1.amount ELSE 0 END AS debit_amount,
  CASE WHEN j1.type_enum = 2 THEN j1.amount ELSE 0 END AS credit_amount, j1.type_enum
FROM journal j1 JOIN journal je ON je.transaction_id = j1.transaction_id LEFT JOIN gl_account g ON g.gl_account_id = j1.gl_account_id
WHERE j1.entry_date = DATE '1996-08-05' AND je.entry_date = DATE '1996-08-05' AND j1.gl_account_id <> 3 AND je.gl_account_id = 3""",
    money="debit_amount credit_amount", date="entry_date", whole="type_enum")
sql("gl_opening_balance", "journal gl_account", """
SELECT j.gl_account_id, gl_name, classification_enum,
  CASE WHEN classification_enum IN (1, 5) THEN sum(CASE WHEN type_enum = 2 THEN amount ELSE 0 END) - sum(CASE WHEN type_enum = 1 THEN amount ELSE 0 END)
    ELSE sum(CASE WHEN type_enum = 1 THEN amount ELSE 0 END) - sum(CASE WHEN type_enum = 2 THEN amount ELSE 0 END) END AS opening_balance
FROM journal j LEFT JOIN gl_account g ON g.gl_account_id = j.gl_account_id WHERE entry_date < DATE '2001-01-01' GROUP BY 1, 2, 3""",
    money="opening_balance", whole="gl_account_id classification_enum")
COLLECT = """SELECT account_id,
  coalesce(sum(CASE WHEN transaction_date >= DATE '2001-07-03' AND transaction_date < DATE '2001-08-03' THEN amount END), 0) AS one_month_collection,
  coalesce(sum(CASE WHEN transaction_date >= DATE '2001-05-04' AND transaction_date < DATE '2001-08-03' THEN amount END), 0) AS three_month_collection,
  max(CAST(transaction_date AS DATE)) AS last_collection_date
FROM txn WHERE type_enum = 1 AND is_reversed = 'No' GROUP BY 1"""
sql("overdraft_collection_ratio", "txn account", f"""
SELECT c.*, round(CAST(three_month_collection AS DOUBLE) / CAST(overdraft_limit AS DOUBLE), 6) AS three_month_ratio
FROM ({COLLECT}) c JOIN account a ON a.account_id = c.account_id""", money="one_month_collection three_month_collection", date="last_collection_date")
sql("limit_utilisation", "txn", f"""
SELECT CAST(transaction_date AS DATE) AS date, count(*) AS transaction_count, sum(amount) AS amount_used, 90000000 AS limit_amount,
  {_percent("sum(amount)", "90000000")} AS percent_utilised
FROM txn WHERE partners = 'TRANSFER' AND response_code = '00' GROUP BY 1""", money="amount_used", date="date", whole="limit_amount")
sql("expected_vs_actual_daily", "schedule payment", """
SELECT e.date, expected, coalesce(actual, 0) AS actual
FROM (SELECT duedate AS date, sum(principal_amount + interest_amount) AS expected FROM schedule GROUP BY 1) e
LEFT JOIN (SELECT transaction_date AS date, sum(amount) AS actual FROM payment GROUP BY 1) p ON p.date = e.date""",
    money="expected actual", date="date")
KEPT = "wallet_name <> 'Supplier#000000001'"
ACCEPTED = f"transaction_response = '00' AND transaction_type IN ('OUTFLOW', 'INFLOW') AND {KEPT}"
sql("wallet_flow_totals", "wallet", f"""
SELECT *, CAST(sum(volume) OVER (PARTITION BY transaction_type) AS BIGINT) AS total_volume, sum(value) OVER (PARTITION BY transaction_type) AS total_value
FROM (SELECT transaction_type, wallet_name, count(*) AS volume, sum(amount) AS value FROM wallet WHERE {ACCEPTED} GROUP BY 1, 2)""",
    money="value total_value")

# -- customer analytics ------------------------------------------------------------------------------------------------

BASE = """base AS (SELECT c.client_id, c.client_category, count(*) AS frequency, sum(amount) AS monetary,
  DATE '2001-08-02' - max(CAST(transaction_date AS DATE)) AS recency, DATE '2001-08-02' - min(c.activation_date) AS age_days, DATE '2001-08-02' AS run_date
  FROM txn JOIN client c ON c.client_id = txn.client_id
  WHERE type_enum IN (1, 2) AND c.client_category <> 'Unclassified' AND c.client_status = 'Active' AND transaction_date >= DATE '2000-08-02'
  GROUP BY 1, 2)"""
CUTS = """cuts AS (SELECT quantile_cont(CAST(recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(CAST(frequency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS f,
  quantile_cont(CAST(monetary AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS m FROM base)"""
SCORED = f"""{BASE}, {CUTS}, scored AS (SELECT client_id, recency, frequency, monetary,
  CASE WHEN recency <= r[1] THEN 5 WHEN recency <= r[2] THEN 4 WHEN recency <= r[3] THEN 3 WHEN recency <= r[4] THEN 2 ELSE 1 END AS r_score,
  CASE WHEN frequency <= f[1] THEN 1 WHEN frequency <= f[2] THEN 2 WHEN frequency <= f[3] THEN 3 WHEN frequency <= f[4] THEN 4 ELSE 5 END AS f_score,
  CASE WHEN CAST(monetary AS DOUBLE) <= m[1] THEN 1 WHEN CAST(monetary AS DOUBLE) <= m[2] THEN 2 WHEN CAST(monetary AS DOUBLE) <= m[3] THEN 3
    WHEN CAST(monetary AS DOUBLE) <= m[4] THEN 4 ELSE 5 END AS m_score
  FROM base, cuts)"""
SEGMENTED = f"""{SCORED}, segmented AS (SELECT *, '' || r_score || f_score || m_score AS rfm_score,
  CASE WHEN r_score IN (1, 2) AND f_score IN (1, 2) THEN 'Hibernating' WHEN r_score IN (1, 2) AND f_score IN (3, 4) THEN 'At Risk'
    WHEN r_score IN (1, 2) AND f_score = 5 THEN 'Cant Loose' WHEN r_score = 3 AND f_score IN (1, 2) THEN 'About To Sleep'
    WHEN r_score = 3 AND f_score = 3 THEN 'Need Attention' WHEN r_score IN (3, 4) AND f_score IN (4, 5) THEN 'Loyal Customers'
    WHEN r_score = 4 AND f_score = 1 THEN 'Promising' WHEN r_score = 5 AND f_score = 1 THEN 'New Customers'
    WHEN r_score IN (4, 5) AND f_score IN (2, 3) THEN 'Potential Loyalists' WHEN r_score = 5 AND f_score IN (4, 5) THEN 'Champions' END AS segment
  FROM scored)"""
sql("rfm_base", "txn client", f"WITH {BASE} --main SELECT * FROM base", money="monetary", date="run_date", whole="recency age_days")
sql("rfm_base_per_account", "txn client account", """
SELECT c.client_id, c.client_category, count(transaction_id) AS frequency, sum(amount) AS monetary,
  DATE '2001-08-02' - max(CAST(transaction_date AS DATE)) AS recency, DATE '2001-08-02' - min(c.activation_date) AS age_days, DATE '2001-08-02' AS run_date
FROM txn LEFT JOIN client c ON c.client_id = txn.client_id LEFT JOIN account a ON a.client_id = c.client_id
WHERE type_enum IN (1, 2) AND c.client_category = 'HOUSEHOLD' AND c.client_status = 'Active' AND transaction_date >= DATE '2000-08-02'
GROUP BY 1, 2""", money="monetary", date="run_date", whole="recency age_days")
sql("rfm_quintiles", "txn client", f"""WITH {BASE}, {CUTS} --main
SELECT p AS prob, round(r[i], 4) AS recency, round(f[i], 4) AS frequency, round(m[i], 4) AS monetary
FROM cuts, (VALUES (1, CAST(0.2 AS DOUBLE)), (2, CAST(0.4 AS DOUBLE)), (3, CAST(0.6 AS DOUBLE)), (4, CAST(0.8 AS DOUBLE))) AS q(i, p)""")
sql("rfm_scores", "txn client", f"WITH {SCORED} --main SELECT * FROM scored", money="monetary", whole="recency r_score f_score m_score")
sql("rfm_segments", "txn client", f"WITH {SEGMENTED} --main SELECT * FROM segmented", money="monetary", whole="recency r_score f_score m_score")
sql("rfm_segment_counts", "txn client", f"""WITH {SEGMENTED} --main
SELECT segment, count(*) AS clients, CAST(floor(count(*) * 100 / sum(count(*)) OVER ()) AS BIGINT) AS share_percent FROM segmented GROUP BY 1""")
sql("active_dormancy", "client txn_bal", """
WITH a AS (SELECT c.client_id, min(c.activation_date) AS opened, min(CAST(transaction_date AS DATE)) AS first_transaction_date,
  max(CAST(transaction_date AS DATE)) AS last_transaction_date, count(*) AS transaction_volume, sum(amount) AS total_transaction_value,
  CAST(sum(running_balance) AS DOUBLE) / count(*) AS avg_bal
  FROM client c JOIN txn_bal t ON t.client_id = c.client_id
  WHERE type_enum IN (1, 2) AND client_status <> 'Closed' AND transaction_date >= DATE '2000-08-02' GROUP BY 1),
b AS (SELECT *, DATE '2001-08-02' - last_transaction_date AS idle FROM a)
--main SELECT client_id, CASE WHEN idle <= 30 THEN 'sticky' ELSE 'non sticky' END AS sticky,
  CASE WHEN idle <= 90 THEN 'active' WHEN idle BETWEEN 91 AND 180 THEN 'inactive' ELSE 'dormant' END AS account_status,
  idle AS days_since_last_transaction, date_diff('month', opened, DATE '2001-08-02') AS age_banked_in_months, first_transaction_date,
  last_transaction_date, transaction_volume, total_transaction_value, avg_bal FROM b""",
    money="total_transaction_value", date="first_transaction_date last_transaction_date", whole="days_since_last_transaction age_banked_in_months")
sql("client_demographics", "client state", f"""
SELECT client_id, client_name, mobile_number, state, CASE gender_code WHEN '29' THEN 'Male' WHEN '30' THEN 'Female' END AS gender, dob_text,
  {COHORT} AS generation, client_tier, client_category, min(activation_date) AS date_onboarded, DATE '2001-08-02' AS run_date
FROM client LEFT JOIN state ON state.state_id = client.state_id WHERE client_status <> 'Closed' GROUP BY ALL""", date="date_onboarded run_date")


def _flag(name: str, source: str) -> str:
    return f"CASE WHEN c.client_id IN (SELECT client_id FROM {source}) THEN '1' ELSE '0' END AS {name}"


_FLAGS = [
    *[_flag(f"uses_{c.lower()}", f"txn WHERE channel = '{c}'") for c in ("MOBILE", "USSD", "CHATBOT", "WALLET")],
    _flag("pays_bills", "txn WHERE partners = 'BILLS'"), _flag("buys_airtime_data", "txn WHERE partners = 'VOUCHER'"),
    _flag("does_cardless", "txn WHERE partners = 'CARDLESS'"), _flag("does_interbank_outflow", "txn WHERE partners = 'NIPCREDIT'"),
    _flag("has_card", "card WHERE card_status = 'ACTIVE'"),
    *[_flag(n, f"account WHERE product_name = '{p}'") for n, p in (
        ("has_usa", "Universal Savings Account"), ("has_fd", "Term Fixed Deposit"), ("has_target_savings", "Target Savings Account"),
        ("has_child_savings", "Child Savings"), ("has_corp_current", "Corporate Current Account"),
        ("has_indv_current", "Individual Current Account"), ("has_staff_current", "Staff Current Account"))],
    _flag("has_credit", "loan WHERE loan_status_id = 300"),
]
sql("product_channel_adoption", "client account txn card loan", f"""
SELECT c.client_id, c.client_category, {', '.join(_FLAGS)}, '2001-08-02' AS run_date FROM client c""")
INPUTS = f"""{BASE}, inputs AS (SELECT client_id, frequency, monetary, age_days / CAST(7 AS DOUBLE) AS t_weekly, recency / CAST(7 AS DOUBLE) AS recency_weekly,
  CAST(monetary AS DOUBLE) / frequency AS mean_value FROM base
  WHERE age_days >= 7 AND recency >= 7 AND frequency >= 1 AND CAST(monetary AS DOUBLE) / frequency >= 1)"""
QUARTERS = f"""{INPUTS}, q AS (SELECT quantile_cont(mean_value, [0.25, 0.5, 0.75]) AS k FROM inputs),
segmented AS (SELECT client_id, monetary, mean_value, CASE WHEN mean_value <= k[1] THEN 'D' WHEN mean_value <= k[2] THEN 'C' WHEN mean_value <= k[3] THEN 'B' ELSE 'A' END AS segment FROM inputs, q)"""
sql("clv_inputs", "txn client", f"WITH {INPUTS} --main SELECT * FROM inputs", money="monetary")
sql("clv_gamma_gamma_score", "txn client", f"""WITH {INPUTS} SELECT client_id, frequency,
  round((1 - p * frequency / (p * frequency + q - 1)) * (v * p / (q - 1)) + p * frequency / (p * frequency + q - 1) * mean_value, 4) AS expected_value
FROM inputs, (SELECT CAST(6.25 AS DOUBLE) AS p, CAST(3.74 AS DOUBLE) AS q, CAST(15.44 AS DOUBLE) AS v)""")
MODEL = f"""{INPUTS}, model AS (SELECT client_id, CAST(frequency - 1 AS DOUBLE) AS x, greatest(t_weekly - recency_weekly, 0.0) AS t_x, t_weekly AS age, mean_value FROM inputs)"""
POINTS = "(VALUES (0, 0.5e0, 8.0e0, 1.6e0, 2.5e0), (1, 1.2e0, 20.0e0, 0.7e0, 3.0e0)) AS pt(point, r, alpha, a, b)"
SPENDS = "(VALUES (0, 6.25e0, 3.74e0, 15.44e0), (1, 2.0e0, 4.0e0, 90000.0e0)) AS pt(point, p, q, v)"
sql("clv_purchase_loglik", "txn client", f"""WITH {MODEL},
legs AS (SELECT *, -(r + x) * ln(alpha + age) AS alive, ln(a) - ln(b + greatest(x, 1) - 1) - (r + x) * ln(alpha + t_x) AS gone FROM model, {POINTS})
--main SELECT point, round(sum(lgamma(r + x) - lgamma(r) + r * ln(alpha) + lgamma(a + b) + lgamma(b + x) - lgamma(b) - lgamma(a + b + x)
  + CASE WHEN x > 0 THEN greatest(alive, gone) + ln(1 + exp(-abs(alive - gone))) ELSE alive END), 3) AS total FROM legs GROUP BY 1""")
sql("clv_spend_loglik", "txn client", f"""WITH {MODEL} --main
SELECT point, round(sum(lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * ln(v) + (p * x - 1) * ln(mean_value) + p * x * ln(x)
  - (p * x + q) * ln(x * mean_value + v)), 3) AS total FROM model, {SPENDS} WHERE x > 0 GROUP BY 1""")


def _expected(weeks: float) -> str:
    """Expected purchases in ``weeks`` by the published formula; its Gauss series is summed term by term."""
    z = f"({weeks} / (alpha + age + {weeks}))"
    series = (f"list_sum([exp(lgamma(r + x + n) - lgamma(r + x) + lgamma(b + x + n) - lgamma(b + x) - lgamma(a + b + x - 1 + n)"
              f" + lgamma(a + b + x - 1) - lgamma(n + 1) + n * ln({z})) for n in range(0, 400)])")
    front = "(a + b + x - 1) / (a - 1)"
    shrink = f"pow((alpha + age) / (alpha + age + {weeks}), r + x)"
    odds = "CASE WHEN x > 0 THEN a / (b + x - 1) * pow((alpha + age) / (alpha + t_x), r + x) ELSE 0 END"
    return f"({front} * (1 - {shrink} * {series}) / (1 + {odds}))"


_STEPS = [4.345 * m for m in range(1, 7)]
_VALUE = " + ".join(
    f"(e{m} - {f'e{m - 1}' if m > 1 else '0'}) / pow(1.01, {m})" for m in range(1, 7)
)
sql("clv_value_at_point", "txn client", f"""WITH {MODEL},
told AS (SELECT client_id, x, {_expected(12.0)} AS w12, {_expected(24.0)} AS w24, {", ".join(f"{_expected(t)} AS e{m}" for m, t in enumerate(_STEPS, 1))},
  (1 - p * x / (p * x + q - 1)) * (v * p / (q - 1)) + p * x / (p * x + q - 1) * mean_value AS spend
  FROM model, {POINTS}, (SELECT 6.25e0 AS p, 3.74e0 AS q, 15.44e0 AS v) WHERE point = 0)
--main SELECT client_id, x, round(w12, 6) AS expected_12_weeks, round(w24, 6) AS expected_24_weeks, round(spend, 3) AS expected_value,
  round(spend * ({_VALUE}), 3) AS clv FROM told""")
sql("clv_quartile_segment", "txn client", f"WITH {QUARTERS} SELECT client_id, mean_value, segment FROM segmented")
sql("clv_segment_stats", "txn client", f"""WITH {QUARTERS} --main
SELECT segment, CAST(sum(monetary) AS DOUBLE) / count(*) AS mean_value, sum(monetary) AS sum_value, count(*) AS clients,
  max(monetary) AS max_value, min(monetary) AS min_value, round(stddev_samp(CAST(monetary AS DOUBLE)), 2) AS std_value
FROM segmented GROUP BY 1""", money="sum_value max_value min_value")

# -- ledger and reports ------------------------------------------------------------------------------------------------

sql("running_balance", "txn_bal", "SELECT transaction_id, account_id, amount, running_balance FROM txn_bal", money="amount running_balance")
sql("latest_running_balance", "txn_bal", """
SELECT account_id, transaction_id AS last_transaction_id, transaction_date AS last_transaction_date, running_balance FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY transaction_date DESC, transaction_id DESC) AS n FROM txn_bal) WHERE n = 1""",
    money="running_balance", ts="last_transaction_date")


def _daily(first: str, last: str) -> str:
    """Every account and day with the running balance of the last movement on or before the day."""
    return f"""daily AS (SELECT a.account_id, a.account_no, a.product_id, d.date, t.running_balance AS closing_balance
  FROM account a JOIN (SELECT CAST(range AS DATE) AS date FROM range(TIMESTAMP '{first}', TIMESTAMP '{last}' + INTERVAL '1 day', INTERVAL '1 day')) d
    ON a.approvedon_date <= d.date
  ASOF LEFT JOIN (SELECT account_id, CAST(transaction_date AS DATE) AS on_date, arg_max(running_balance, transaction_id) AS running_balance
    FROM txn_bal GROUP BY 1, 2) t ON t.account_id = a.account_id AND t.on_date <= d.date)"""


sql("closing_balance_daily", "account txn_bal", f"WITH {_daily('2001-07-01', '2001-07-31')} --main SELECT * FROM daily",
    money="closing_balance", date="date", whole="product_id")
ORACLE["closing_balance_backfill"] = ORACLE["closing_balance_daily"]
sql("avg_balance_by_month", "account txn_bal", f"""WITH {_daily('2001-05-01', '2001-07-31')}
SELECT account_no, strftime(date, '%Y-%m') AS month, CAST(sum(closing_balance) AS DOUBLE) / count(closing_balance) AS avg_balance FROM daily GROUP BY 1, 2""")
sql("monthly_balance_totals", "account txn_bal", f"""WITH {_daily('2001-01-01', '2001-07-31')} --main
SELECT date, sum(closing_balance) AS total_balance, count(*) FILTER (closing_balance <> 0) AS nonzero_accounts FROM daily
WHERE date = last_day(date) GROUP BY 1""", money="total_balance", date="date")
sql("closing_balance_monthly", "account txn_bal", f"WITH {_daily('2001-01-01', '2001-07-31')} --main SELECT * FROM daily WHERE date = last_day(date)",
    money="closing_balance", date="date", whole="product_id")
_staff_months = []
for _m in range(1, 8):
    _staff_months.append(f"CAST(sum(closing_balance) FILTER (month(date) = {_m}) AS DOUBLE) AS \"2001-{_m:02d}_value\"")
    _staff_months.append(f"CAST(count(*) FILTER (month(date) = {_m} AND closing_balance <> 0) AS BIGINT) AS \"2001-{_m:02d}_count\"")
sql("staff_balance_pivot", "account txn_bal client", f"""WITH {_daily('2001-01-01', '2001-07-31')}
SELECT referred_by_id, {', '.join(_staff_months)} FROM daily d JOIN account a ON a.account_id = d.account_id JOIN client c ON c.client_id = a.client_id
WHERE d.date = last_day(d.date) AND referred_by_id IS NOT NULL GROUP BY 1""")
sql("avg_balance_wide", "account txn_bal", f"""WITH {_daily('2001-05-01', '2001-07-31')}
SELECT account_no, {', '.join(f"CAST(sum(closing_balance) FILTER (month(date) = {m}) AS DOUBLE) / count(closing_balance) FILTER (month(date) = {m}) AS avg_balance_2001_{m:02d}" for m in (5, 6, 7))}
FROM daily GROUP BY 1""")
sql("balances_wide_to_long", "account txn_bal", f"""WITH {_daily('2001-07-25', '2001-07-31')} --main
SELECT account_no, date, closing_balance AS balance FROM daily""", money="balance", date="date")
LINES = """SELECT transaction_id, session_id, transaction_date, account_no, product_name, CASE WHEN type_enum = 2 THEN amount ELSE 0 END AS debit,
  CASE WHEN type_enum = 1 THEN amount ELSE 0 END AS credit, running_balance AS balance, is_reversed AS reversed, remarks AS narration FROM txn_bal"""
for _name in ("closing_balance_stored", "closing_balance_carried"):
    sql(_name, "txn", """
SELECT account_id, sum(CASE WHEN type_enum = 1 THEN amount ELSE -amount END) AS closing_balance, DATE '2001-08-02' AS date
FROM txn WHERE transaction_date < TIMESTAMP '2001-08-03' GROUP BY 1""", money="closing_balance", date="date")
sql("bank_statement_lines", "txn_bal", LINES, money="debit credit balance", ts="transaction_date")
sql("reversal_lines", "txn", """
SELECT transaction_id, account_no, amount, remarks AS transaction_remark, transaction_date FROM txn WHERE remarks LIKE '%Reversal Of transactionId%'""",
    money="amount", ts="transaction_date")
sql("statement_with_reference", "txn_bal wallet", f"""
SELECT l.transaction_id, l.session_id, debit, credit, transaction_reference FROM ({LINES}) l
LEFT JOIN (SELECT session_id, min(transaction_id) AS transaction_reference FROM wallet GROUP BY 1) w ON w.session_id = l.session_id""",
    money="debit credit")
sql("negative_balance_summary", "account", """
SELECT product_id, product_name, sum(balance) AS total_principal_balance, count(*) AS accounts FROM account WHERE balance < 0 GROUP BY 1, 2""",
    money="total_principal_balance", whole="product_id")
sql("negative_balance_accounts", "txn account client", """
WITH l AS (SELECT account_id, arg_max(transaction_id, (transaction_date, transaction_id)) AS last_transaction_id,
  sum(CASE WHEN type_enum = 1 THEN amount ELSE -amount END) AS running_balance
  FROM txn WHERE is_reversed = 'No' AND transaction_date < DATE '2001-08-03' GROUP BY 1)
--main SELECT l.account_id, account_no, client_name, upper(product_name) AS product, last_transaction_id, overdraft_limit, running_balance
FROM l JOIN account a ON a.account_id = l.account_id LEFT JOIN client c ON c.client_id = a.client_id WHERE running_balance < -1000""",
    money="overdraft_limit running_balance")
sql("wallet_statement_all", "wallet bank", """
SELECT wallet_name, CASE transaction_type WHEN 'OUTFLOW' THEN 'Outflow' WHEN 'INFLOW' THEN 'Inflow' ELSE 'Initial Inflow' END AS section, transaction_id,
  statement_ids, CASE WHEN transaction_type <> 'OUTFLOW' THEN from_account_no END AS from_account_no,
  CASE WHEN transaction_type <> 'OUTFLOW' THEN bank_name END AS from_bank_name, to_account_no, session_id, amount, transaction_response, time
FROM wallet LEFT JOIN bank ON bank_code = from_bank""", money="amount", ts="time")
sql("pooled_multi_leg", "wallet", """
SELECT wallet_name, pooled_id AS transaction_id, count(*) AS legs, sum(amount) AS amount FROM wallet
WHERE transaction_type <> 'INITIAL INFLOW' AND transaction_response NOT IN ('02', '99') GROUP BY 1, 2 HAVING count(*) > 1""", money="amount")
FLOWS = """count(CASE WHEN to_bank = '999999' THEN 1 END) AS intra_volume, count(CASE WHEN to_bank <> '999999' THEN 1 END) AS inter_volume,
  coalesce(sum(CASE WHEN to_bank = '999999' THEN amount END), 0) AS intra_value, coalesce(sum(CASE WHEN to_bank <> '999999' THEN amount END), 0) AS inter_value"""
sql("wallet_intra_inter", "wallet", f"""
SELECT wallet_name, transaction_type, CAST(time AS DATE) AS date, {FLOWS} FROM wallet WHERE {ACCEPTED} GROUP BY 1, 2, 3""",
    money="intra_value inter_value", date="date")
sql("top_transfer_wallets", "wallet", f"""
SELECT wallet_name, count(*) AS volume, sum(amount) AS value FROM wallet WHERE {ACCEPTED} AND transaction_type = 'OUTFLOW' GROUP BY 1
ORDER BY volume DESC, wallet_name LIMIT 5""", money="value")
CALLS = """calls AS (SELECT *, CASE WHEN resource IN ('/view', '/click') AND resource_value LIKE '%/%' THEN resource || '-account' ELSE resource END AS resource_consumed
  FROM api WHERE subscriber <> 'user-1' AND response_status NOT IN ('Fail', 'Failed', 'FAIL', 'FAILED'))"""
sql("api_calls_by_resource", "api", f"WITH {CALLS} SELECT resource_consumed, count(*) AS calls FROM calls GROUP BY 1")
sql("api_calls_by_client", "api", f"WITH {CALLS} SELECT subscriber, resource_consumed, count(*) AS calls FROM calls GROUP BY 1, 2")
sql("top_api_clients", "api", f"WITH {CALLS} SELECT subscriber, count(*) AS calls FROM calls GROUP BY 1 ORDER BY calls DESC, subscriber LIMIT 5")


def _group_kpi(label: str, names: str) -> str:
    return f"""SELECT 'Total {label} calls' AS metric, format('{{:,}}', count(*)) AS value FROM week WHERE resource_consumed IN ({names})
UNION ALL SELECT 'Top {label} client', (SELECT subscriber FROM week WHERE resource_consumed IN ({names}) GROUP BY 1 ORDER BY count(*) DESC, subscriber DESC LIMIT 1)"""


_SUM = "'N' || format('{{:,.2f}}', CAST(sum(amount) AS DOUBLE))".replace("{{", "{").replace("}}", "}")
_FLOW_KPIS = " UNION ALL ".join(
    f"SELECT 'Total {name} volume', format('{{:,}}', count(*)) FROM flows {cond} UNION ALL SELECT 'Total {name} value', {_SUM} FROM flows {cond}"
    for name, cond in (("transfer", ""), ("outflow", "WHERE transaction_type = 'OUTFLOW'"), ("inflow", "WHERE transaction_type = 'INFLOW'"))
)
sql("weekly_kpi_unpivot", "api wallet account txn_bal", f"""WITH {CALLS}, {_daily('2001-07-26', '2001-08-01')},
deposits AS (SELECT account_no, CAST(round(CAST(sum(closing_balance) AS DOUBLE) / count(closing_balance), 2) AS DECIMAL(28,2)) AS d FROM daily
  WHERE account_no IN ({WALLET_ACCOUNTS}) GROUP BY 1), week AS (SELECT * FROM calls WHERE date >= TIMESTAMP '2024-01-24' AND date < TIMESTAMP '2024-01-31'),
flows AS (SELECT * FROM wallet WHERE {ACCEPTED} AND time >= TIMESTAMP '2001-07-26' AND time < TIMESTAMP '2001-08-02')
{_group_kpi('lookup', "'/view', '/view-account'")} UNION ALL {_group_kpi('click', "'/click', '/click-account'")} UNION ALL {_group_kpi('sale', "'/purchase'")}
UNION ALL {_FLOW_KPIS}
UNION ALL SELECT 'Cumulative average deposit', 'N' || format('{{:,.2f}}', CAST(sum(d) AS DOUBLE)) FROM deposits""")
sql("kpi_unpivot", "txn", """
SELECT 'transactions' AS metric, CAST(count(*) AS VARCHAR) AS value FROM txn UNION ALL SELECT 'amount', CAST(sum(amount) AS VARCHAR) FROM txn
UNION ALL SELECT 'clients', CAST(count(DISTINCT client_id) AS VARCHAR) FROM txn""")
sql("mean_deposit_last_week", "account txn_bal", f"""WITH {_daily('2001-07-20', '2001-08-01')}
SELECT account_no, CAST(sum(closing_balance) AS DOUBLE) / count(closing_balance) AS avg_deposit FROM daily
WHERE date >= DATE '2001-07-26' AND date < DATE '2001-08-02' AND account_no IN ({WALLET_ACCOUNTS}) GROUP BY 1""")
ALERTS = f"""alerts AS (SELECT transaction_id, txn.client_id, client_name, client_tier, account_no, product_name, transaction_type, amount, transaction_date, remarks, mobile_number
  FROM txn JOIN client ON client.client_id = txn.client_id
  WHERE {LARGE} AND amount >= CASE client_tier WHEN 'Tier 1' THEN 100000 WHEN 'Tier 2' THEN 200000 WHEN 'Tier 3' THEN 200000 END)"""
sql("tier_large_txn_alert", "txn client", f"WITH {ALERTS} --main SELECT * FROM alerts", money="amount", ts="transaction_date")
sql("tier_alerts_of_day", "txn_bal client", f"""
SELECT transaction_id, t.client_id, client_name, client_tier, account_no, product_name, transaction_type, amount, transaction_date, remarks, mobile_number, running_balance
FROM txn_bal t JOIN client ON client.client_id = t.client_id
WHERE {LARGE} AND amount >= CASE client_tier WHEN 'Tier 1' THEN 100000 ELSE 200000 END AND CAST(transaction_date AS DATE) = DATE '1998-07-06'""",
    money="amount running_balance", ts="transaction_date")
sql("repeat_txn_clients", "txn client", f"""WITH {ALERTS} --main
SELECT transaction_id, client_id, transaction_type, alert_date, hits, amount FROM (
  SELECT *, date_trunc('month', transaction_date) AS alert_date, count(*) OVER (PARTITION BY client_id, transaction_type, date_trunc('month', transaction_date)) AS hits
  FROM alerts WHERE client_tier = 'Tier 3') WHERE hits > 1""", money="amount", date="alert_date")
sql("manual_accounts_opened", "account client", f"""
SELECT account_id, account_no, a.client_id, c.client_name, c.client_tier, product_name, approvedon_date AS activation_date, risk_score, {BAND} AS aml_risk_rating,
  o.client_name AS account_officer_name
FROM account a LEFT JOIN client c ON c.client_id = a.client_id LEFT JOIN {RISK} r ON r.client_id = a.client_id LEFT JOIN client o ON o.client_id = c.referred_by_id
WHERE submittedby_userid <> 31 AND product_id IN (24, 26, 29, 33, 212)""", date="activation_date")
sql("new_account_compliance", "account client", f"""
WITH blocks AS (SELECT account_id, CASE WHEN account_id % 3 = 0 THEN 'BLOCK DEBIT' WHEN account_id % 3 = 1 THEN 'BLOCK CREDIT' ELSE 'NOTE' END AS sub_status FROM account WHERE balance < 0)
--main SELECT c.client_id, client_name, activation_date, min(account_no) AS account_no, arg_min(submittedby_userid, account_no) AS opened_by,
  max(sub_status) AS sub_status, any_value(risk_score) AS risk_score, {BAND.replace('risk_score', 'any_value(risk_score)')} AS aml_risk_rating
FROM client c JOIN account a ON a.client_id = c.client_id AND product_id IN (29, 31, 33)
LEFT JOIN blocks b ON b.account_id = a.account_id AND sub_status IN ('BLOCK DEBIT', 'BLOCK CREDIT')
LEFT JOIN {RISK} r ON r.client_id = c.client_id WHERE activation_date = DATE '1994-03-15' GROUP BY 1, 2, 3""", date="activation_date", whole="opened_by")
RATIO = "format('{{:,.2f}}', " + _percent("coalesce({c}, 0)", "overdraft_limit") + ") || '%'"
sql("overdraft_book", "account client txn", f"""
SELECT a.account_id, account_no, c.client_name, overdraft_limit, balance AS principal_balance, overdraft_limit + balance AS overdrawn_amount,
  overdraft_start AS disbursement_date, overdraft_end AS maturity_date, {MATURITY.format(d='overdraft_end')} AS remaining_days_to_maturity,
  last_collection_date, coalesce(one_month_collection, 0) AS one_month_collection, coalesce(three_month_collection, 0) AS three_month_collection,
  {RATIO.format(c='one_month_collection')} AS one_month_ratio, {RATIO.format(c='three_month_collection')} AS three_month_ratio, o.client_name AS account_officer
FROM account a JOIN client c ON c.client_id = a.client_id LEFT JOIN ({COLLECT}) k ON k.account_id = a.account_id
LEFT JOIN client o ON o.client_id = c.referred_by_id WHERE overdraft_start IS NOT NULL""",
    money="overdraft_limit principal_balance overdrawn_amount one_month_collection three_month_collection",
    date="disbursement_date maturity_date last_collection_date")
ORACLE["overdraft_book_bounded"] = ORACLE["overdraft_book"]
sql("overdrafts_granted", "account client", """
SELECT account_id, account_no, client_name, overdraft_limit, overdraft_start, overdraft_end FROM account a JOIN client c ON c.client_id = a.client_id
WHERE overdraft_start = DATE '2001-06-03'""", money="overdraft_limit", date="overdraft_start overdraft_end")
POS_ACCOUNT = "(SELECT *, '10' || lpad(CAST(merchant_id * 3 AS VARCHAR), 8, '0') AS account_no FROM pos)"
POS_ROWS = f"""SELECT transaction_id, transaction_date, terminal_id, a.client_id, client_name, p.status_code, 'POSV' AS vendor, amount, settled_amount,
  amount - settled_amount AS charges, p.account_no, product_name, left(card_pan, 6) AS first_six_digits, right(card_pan, 4) AS last_four_digits
FROM {POS_ACCOUNT} p LEFT JOIN account a ON a.account_no = p.account_no LEFT JOIN client c ON c.client_id = a.client_id"""
sql("pos_transactions", "pos account client", f"{POS_ROWS} WHERE p.status_code = '00'", money="amount settled_amount charges", ts="transaction_date")
sql("pos_failed_three_months", "pos account client", f"{POS_ROWS} WHERE p.status_code <> '00' AND transaction_date >= TIMESTAMP '2001-05-02'",
    money="amount settled_amount charges", ts="transaction_date")
sql("pos_terminals", "pos account client", f"""
SELECT terminal_id, p.account_no, product_name, client_name, count(*) AS volume, sum(amount) AS value, sum(amount - settled_amount) AS charges
FROM {POS_ACCOUNT} p LEFT JOIN account a ON a.account_no = p.account_no LEFT JOIN client c ON c.client_id = a.client_id
WHERE p.status_code = '00' GROUP BY 1, 2, 3, 4""", money="value charges")
sql("term_deposit_maturity", "term_deposit", f"""
SELECT account_id, client_id, deposit_period, deposit_amount, maturity_amount, start_date, maturity_date,
  maturity_date - DATE '2001-08-02' AS days_to_maturity, {MATURITY.format(d='maturity_date')} AS maturity_band
FROM term_deposit""", money="deposit_amount maturity_amount", date="start_date maturity_date", whole="deposit_period days_to_maturity")
sql("deposits_expected_vs_actual", "term_deposit", """
SELECT maturity_date, count(*) AS deposits, sum(maturity_amount) AS expected_amount, sum(balance) AS actual_balance FROM term_deposit GROUP BY 1""",
    money="expected_amount actual_balance", date="maturity_date")
sql("fresh_vs_rollover", "txn account", """
SELECT t.transaction_id, t.client_id, t.account_no, t.amount, CAST(t.transaction_date AS DATE) AS booked_on,
  CASE WHEN submittedby_userid = 31 THEN 'app booking' ELSE 'manual booking' END AS booking_channel,
  CASE WHEN EXISTS (SELECT 1 FROM txn d WHERE d.client_id = t.client_id AND d.transaction_date = t.transaction_date AND d.product_id = 36
    AND d.is_reversed = 'No' AND d.type_enum = 2) THEN 'Roll over' ELSE 'Fresh' END AS booking_type
FROM txn t LEFT JOIN account a ON a.account_id = t.account_id WHERE t.product_id = 36 AND t.is_reversed = 'No' AND t.type_enum = 1""",
    money="amount", date="booked_on")
sql("loan_star_enrich", "loan code_value staff_user client", """
SELECT loan_id, l.client_id, client_name, s.label AS loan_status, p.label AS purpose, k.label AS collateral, d.label AS loan_product,
  o.username AS officer, v.username AS approver, principal_disbursed, interest_charged, total_expected_repayment
FROM loan l LEFT JOIN code_value s ON s.code_id = loan_status_id AND s.code_name = 'status'
LEFT JOIN code_value p ON p.code_id = purpose_id AND p.code_name = 'purpose' LEFT JOIN code_value k ON k.code_id = collateral_id AND k.code_name = 'collateral'
LEFT JOIN code_value d ON d.code_id = l.product_id AND d.code_name = 'product' LEFT JOIN staff_user o ON o.user_id = officer_id
LEFT JOIN staff_user v ON v.user_id = approver_id LEFT JOIN client c ON c.client_id = l.client_id""",
    money="principal_disbursed interest_charged total_expected_repayment")
sql("schedule_enriched", "schedule loan", """
SELECT s.loan_id, duedate, principal_amount, interest_amount, client_id, loan_status_id FROM schedule s LEFT JOIN loan l ON l.loan_id = s.loan_id""",
    money="principal_amount interest_amount", date="duedate", whole="loan_status_id")
sql("staff_loan_attribution", "loan client", """
SELECT c.referred_by_id, r.client_name AS staff_name, count(*) AS loans, sum(principal_disbursed) AS principal
FROM loan l JOIN client c ON c.client_id = l.client_id LEFT JOIN client r ON r.client_id = c.referred_by_id
WHERE c.referred_by_id IS NOT NULL GROUP BY 1, 2""", money="principal", whole="loans")
sql("accounts_open_or_closed_this_year", "account", """
SELECT account_id, client_id, product_name, approvedon_date, closedon_date FROM account WHERE closedon_date IS NULL
UNION SELECT account_id, client_id, product_name, approvedon_date, closedon_date FROM account WHERE year(closedon_date) >= 2001""",
    date="approvedon_date closedon_date")
sql("staff_loans", "loan client", """
SELECT loan_id, l.client_id, principal_disbursed, disbursedon_date, c.referred_by_id, r.client_name AS staff_name
FROM loan l JOIN client c ON c.client_id = l.client_id JOIN client r ON r.client_id = c.referred_by_id""", money="principal_disbursed", ts="disbursedon_date")
sql("loans_disbursed_month", "loan client", """
SELECT loan_id, l.client_id, client_name, client_tier, principal_disbursed, disbursedon_date FROM loan l LEFT JOIN client c ON c.client_id = l.client_id
WHERE strftime(disbursedon_date, '%Y-%m') = '2001-07'""", money="principal_disbursed", ts="disbursedon_date")
sql("partner_loans_yesterday", "loan", """
SELECT loan_id, client_id, product_id, principal_disbursed, total_expected_repayment FROM loan
WHERE product_id IN (1, 2, 3) AND CAST(disbursedon_date AS DATE) = DATE '2001-07-24'""", money="principal_disbursed total_expected_repayment", whole="product_id")
sql("open_or_closed_this_year", "loan", """
SELECT loan_id, client_id, disbursedon_date, closedon_date FROM loan WHERE closedon_date IS NULL
UNION SELECT loan_id, client_id, disbursedon_date, closedon_date FROM loan WHERE closedon_date >= DATE '2001-01-01'""", date="closedon_date", ts="disbursedon_date")
sql("downline_split", "account client loan", """
SELECT c.referred_by_id, c.client_id, c.client_name, i.item_id, i.product_name, i.amount, i.kind FROM (
  SELECT client_id, account_id AS item_id, product_name, balance AS amount, CASE WHEN balance < 0 THEN 'overdraft' ELSE 'deposit' END AS kind
  FROM account WHERE closedon_date IS NULL
  UNION ALL SELECT client_id, loan_id, 'Loan', principal_disbursed, 'loan' FROM loan) i JOIN client c ON c.client_id = i.client_id
WHERE c.referred_by_id IS NOT NULL""", money="amount")
sql("deposit_drive", "txn client", """
WITH staff AS (SELECT CAST(client_id AS VARCHAR) AS staff_id, client_name AS staff_name FROM client WHERE client_id IN (SELECT referred_by_id FROM client)
  UNION ALL SELECT 'others', ''),
moves AS (SELECT coalesce(CAST(referred_by_id AS VARCHAR), 'others') AS staff_id, sum(CASE WHEN type_enum = 1 THEN amount END) AS i,
  sum(CASE WHEN type_enum = 2 THEN amount END) AS o, sum(CASE WHEN type_enum = 1 AND product_id = 36 THEN amount END) AS f
  FROM txn JOIN client c ON c.client_id = txn.client_id WHERE transaction_date >= DATE '2001-07-01' AND transaction_date < DATE '2001-08-02' GROUP BY 1)
--main SELECT staff.staff_id, staff_name, coalesce(i, 0) AS total_inflow, coalesce(o, 0) AS total_outflow, coalesce(f, 0) AS fd_inflow
FROM staff LEFT JOIN moves ON moves.staff_id = staff.staff_id""", money="total_inflow total_outflow fd_inflow")


def _pivot(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for name, expr in columns)


_DRIVE_DAYS = [f"2001-07-{d}" for d in range(23, 28)]
_DRIVE = []
for _day in _DRIVE_DAYS:
    _on = f"CAST(transaction_date AS DATE) = DATE '{_day}'"
    _DRIVE.append((_day.replace("-", "_") + "_inflow", f"CAST(coalesce(sum(CASE WHEN {_on} THEN amount END), 0) AS DOUBLE)"))
    _DRIVE.append((_day.replace("-", "_") + "_fd_inflow", f"CAST(coalesce(sum(CASE WHEN {_on} AND product_id = 36 THEN amount END), 0) AS DOUBLE)"))
sql("deposit_drive_pivot", "txn client", f"""
SELECT coalesce(CAST(referred_by_id AS VARCHAR), 'others') AS staff_id, {_pivot(_DRIVE)} FROM txn JOIN client c ON c.client_id = txn.client_id
WHERE type_enum = 1 AND transaction_date >= DATE '2001-07-23' AND transaction_date < DATE '2001-07-28' GROUP BY 1""")
_MONTHS = []
for _m in range(1, 7):
    _on = f"strftime(disbursedon_date, '%Y-%m') = '2001-{_m:02d}'"
    _MONTHS.append((f"2001_{_m:02d}_value", f"CAST(sum(CASE WHEN {_on} THEN principal_disbursed END) AS DOUBLE)"))
    _MONTHS.append((f"2001_{_m:02d}_count", f"CAST(sum(CASE WHEN {_on} THEN 1 END) AS BIGINT)"))
sql("staff_month_pivot", "loan client", f"""
SELECT referred_by_id, {_pivot(_MONTHS)} FROM loan l JOIN client c ON c.client_id = l.client_id
WHERE referred_by_id IS NOT NULL AND disbursedon_date >= DATE '2001-01-01' AND disbursedon_date < DATE '2001-07-01' GROUP BY 1""")
sql("corporate_accounts_opened", "account client", """
SELECT account_no, product_name, c.client_name, approvedon_date, CASE WHEN c.referred_by_id IS NULL THEN 'parent' ELSE 'sub' END AS level, r.client_name AS referrer_name
FROM account a LEFT JOIN client c ON c.client_id = a.client_id LEFT JOIN client r ON r.client_id = c.referred_by_id
WHERE product_id = 26 AND approvedon_date >= DATE '1994-03-01' AND approvedon_date < DATE '1994-04-01'""", date="approvedon_date")
sql("signups_last_month", "client", """
SELECT activation_date, count(*) AS signups, count(CASE WHEN onboard_channel = 'MobileApp' THEN 1 END) AS app_signups
FROM client WHERE strftime(activation_date, '%Y-%m') = '1994-09' GROUP BY 1""", date="activation_date")
BRANDED = "branded AS (SELECT * REPLACE (CASE WHEN biller_code = 'Blank' THEN remarks ELSE biller_code END AS biller_code) FROM (SELECT * EXCLUDE (biller) FROM branded_item))"
_TOLD = f"""airtime AS (SELECT *, {_brand_case('biller_code')} AS brand FROM branded WHERE {_brand_case('biller_code')} IS NOT NULL),
bills AS (SELECT *, {_biller_case('biller_code')} AS biller_by_rule FROM branded WHERE {_brand_case('biller_code')} IS NULL)"""
for _name, _body in (
    ("airtime_transactions", "SELECT * FROM airtime"), ("bills_transactions", "SELECT * FROM bills"),
    ("airtime_by_brand", "SELECT brand, count(*) AS purchases, sum(amount) AS amount FROM airtime GROUP BY 1"),
    ("bills_by_rule", "SELECT biller_by_rule, count(*) AS purchases, sum(amount) AS amount FROM bills GROUP BY 1"),
):
    _whole_row = _name.endswith("transactions")
    sql(_name, "branded_item", f"WITH {BRANDED}, {_TOLD} --main {_body}", money="amount settled_amount" if _whole_row else "amount",
        ts="transaction_date" if _whole_row else "")
sql("unmapped_biller_codes", "bill_item", """
SELECT biller_code || ' ' || biller_id AS biller_code FROM bill_item GROUP BY 1
EXCEPT SELECT biller_code || ' ' || biller_id FROM bill_item WHERE transaction_date < TIMESTAMP '2001-01-01'""")
CHARGE_TYPE = "CASE WHEN charge <= 1000 THEN 'Virtual' WHEN charge > 1000 THEN 'Physical' ELSE 'Unclassified' END"
sql("card_requests", "card account", f"""
SELECT card_id, k.client_id, account_no, CASE WHEN group_id IS NULL THEN a.client_id ELSE group_id END AS owner_id, n_name AS group_name,
  charge AS amount_charged, {CHARGE_TYPE} AS card_type
FROM card k LEFT JOIN account a ON a.account_id = k.account_id LEFT JOIN nation ON 9000000 + n_nationkey = group_id""", money="amount_charged")
sql("card_transactions", "card_txn account client", f"""
WITH own AS ({OWNER})
--main SELECT k.id, k.client_id, k.transaction_type, k.amount, k.transaction_date, k.transaction_status, k.client_id * 2 AS account_id, own.account_no, owner_id, owner_name
FROM card_txn k LEFT JOIN own ON own.account_id = k.client_id * 2
WHERE k.id > (SELECT coalesce(max(id), 0) FROM card_txn WHERE transaction_date < DATE '1995-01-10')""", money="amount", ts="transaction_date")
sql("terminal_wallet_load", "wallet bank client", """
SELECT transaction_id, statement_ids, transaction_type, transaction_response, from_account_no, from_bank, bank_name, to_account_no, client_name, amount, time
FROM wallet LEFT JOIN bank ON bank_code = from_bank LEFT JOIN client ON '20' || lpad(CAST(client_id AS VARCHAR), 8, '0') = to_account_no
WHERE wallet_name ILIKE '%supplier#%7%' AND transaction_id > (SELECT coalesce(max(transaction_id), 0) FROM wallet
  WHERE wallet_name ILIKE '%supplier#%7%' AND transaction_type = 'INITIAL INFLOW' AND time < TIMESTAMP '1995-06-01')""",
    money="amount", ts="time", whole="from_bank")
sql("card_type_by_charge", "card", f"SELECT {CHARGE_TYPE} AS card_type, count(*) AS cards FROM card GROUP BY 1")
sql("cards_produced", "card client", """
SELECT card_id, k.client_id, client_name, pan_type, card_status, expiry_code, date_created FROM card k LEFT JOIN client c ON c.client_id = k.client_id""", date="date_created")
sql("cards_expiring_year", "card", """
SELECT CAST(expiry_code AS BIGINT) AS expiry_date, count(*) AS cards_to_expire FROM card WHERE left(expiry_code, 2) = '94' GROUP BY 1""")
sql("client_master", "client state account", f"""
WITH cat AS ({CATEGORY})
--main SELECT client.client_id, {LABELS}, activation_date, closedon_date, referred_by_id, daily_withdraw_limit, max_transaction_limit, mobile_number, state,
  cat.client_category, (SELECT min('RC' || account_id) FROM account a WHERE a.client_id = client.client_id) AS registry_no
FROM client LEFT JOIN state ON state.state_id = client.state_id LEFT JOIN cat ON cat.client_id = client.client_id""",
    money="daily_withdraw_limit max_transaction_limit", date="activation_date closedon_date")
sql("group_clients", "account", """
SELECT 9000000 + n_nationkey AS group_id, n_name AS group_name, coalesce(client_id, 0) AS linked_client_id
FROM nation LEFT JOIN account ON group_id = 9000000 + n_nationkey""", whole="group_id")
sql("account_master", "account client", f"""
WITH own AS ({OWNER})
--main SELECT a.account_id, a.account_no, owner_id, owner_name, product_id, product_name,
  CASE WHEN product_id IN (36, 30) THEN 'deposit' WHEN product_id = 26 THEN 'current' ELSE 'savings' END AS account_category,
  CASE WHEN closedon_date IS NULL THEN 'Active' ELSE 'Closed' END AS account_status, approvedon_date AS activation_date, closedon_date
FROM account a JOIN own ON own.account_id = a.account_id""", date="activation_date closedon_date", whole="product_id")
sql("wallet_bills_week", "bill", """
SELECT transaction_id, biller, amount, transaction_date FROM bill WHERE channel = 'WALLET' AND transaction_date >= TIMESTAMP '2001-07-26'
AND transaction_date < TIMESTAMP '2001-08-02'""", money="amount", ts="transaction_date")

# -- marts -------------------------------------------------------------------------------------------------------------


def mart(name: str, views: str, ts: str, source: str, measures: str, as_of: str, keys: str = "", money: str = "",
         grains: tuple[str, ...] = ("monthly", "ytd")) -> None:
    month, year = as_of[:7], as_of[:4]
    extra = f", {keys}" if keys else ""
    if "monthly" in grains:
        sql(f"mart_{name}_monthly", views, f"""SELECT strftime({ts}, '%Y-%m') AS month{extra}, {measures} FROM {source}
WHERE strftime({ts}, '%Y-%m') < '{month}' GROUP BY ALL""", money=money)
    if "ytd" in grains:
        sql(f"mart_{name}_ytd", views, f"""SELECT strftime({ts}, '%Y-%m-%d') AS date{extra}, {measures} FROM {source}
WHERE year({ts}) = {year} AND CAST({ts} AS DATE) <= DATE '{as_of}' GROUP BY ALL""", money=money)


def channel_measures() -> tuple[str, str]:
    parts, money = [], []
    for c in ("MOBILE", "USSD", "CHATBOT"):
        parts.append(f"count(CASE WHEN channel = '{c}' THEN 1 END) AS {c.lower()}_volume")
        parts.append(f"coalesce(sum(CASE WHEN channel = '{c}' THEN amount END), 0) AS {c.lower()}_value")
        money.append(f"{c.lower()}_value")
    parts += ["count(*) AS total_volume", "sum(amount) AS total_value"]
    return ", ".join(parts), " ".join([*money, "total_value"])


C, E, O = "1994-10-15", "2024-02-10", "2001-08-02"
RETAIL = """(SELECT a.*, c.client_tier, c.gender_code, c.activation_date, c.activatedon_userid FROM account a JOIN client c ON c.client_id = a.client_id
  WHERE a.product_id IN {p}) x"""
R = RETAIL.format(p="(29, 31, 33)")
mart("retail_customers", "account client", "activation_date", R, "count(*) AS customers", C)
mart("retail_tier", "account client", "activation_date", R, """count(CASE WHEN client_tier = 'Tier 1' THEN 1 END) AS tier_1,
 count(CASE WHEN client_tier = 'Tier 2' THEN 1 END) AS tier_2, count(CASE WHEN client_tier = 'Tier 3' THEN 1 END) AS tier_3, count(*) AS total_customers""", C)
mart("retail_accounts", "account client", "approvedon_date", RETAIL.format(p="(24, 30, 33)"), "count(*) AS no_accounts", C, "product_name")
mart("retail_onboard_channel", "account client", "activation_date", R,
     "count(CASE WHEN activatedon_userid = 31 THEN 1 END) AS mobile, count(CASE WHEN activatedon_userid <> 31 THEN 1 END) AS others", C)
mart("social_onboard", "client", "activation_date", "(SELECT * FROM client WHERE onboard_channel = 'WhatsApp') x", "count(*) AS customers", C)
mart("backend_onboard", "account client", "activation_date", f"(SELECT * FROM {R} WHERE submittedby_userid <> 31) x", "count(*) AS accounts", C, grains=("monthly",))
mart("retail_gender", "account client", "activation_date",
     f"(SELECT activation_date, CASE gender_code WHEN '29' THEN 'Male' WHEN '30' THEN 'Female' END AS gender FROM {R} WHERE gender_code IS NOT NULL) x",
     "count(*) AS customers", C, "gender", grains=("ytd",))
mart("card_issue", "card", "date_created", "card", "count(*) AS cards_issued", C)
mart("card_status", "card", "date_created", "card", """count(CASE WHEN pan_type = 'PHYSICAL' THEN 1 END) AS total_physical,
 count(CASE WHEN pan_type = 'VIRTUAL' THEN 1 END) AS total_virtual, count(CASE WHEN card_status = 'ACTIVE' THEN 1 END) AS total_active,
 count(CASE WHEN card_status = 'EXPIRED' THEN 1 END) AS total_expired, count(CASE WHEN card_status = 'BLOCKED' THEN 1 END) AS total_blocked""", C)
mart("business_dropoff", "client", "activation_date", "(SELECT * FROM client WHERE image_id IS NULL) x", "count(*) AS dropoffs", C)

CH, CHM = channel_measures()
IN3 = "channel IN ('MOBILE', 'USSD', 'CHATBOT')"
VV = "count(*) AS volume, sum(amount) AS value"
mart("intrabank", "txn", "transaction_date", f"(SELECT * FROM txn WHERE ({IN3} OR channel IS NULL) AND partners_description = 'Internal transfer') x",
     f"count(CASE WHEN channel IS NULL THEN 1 END) AS null_volume, {CH}", O, money=CHM)
for _name in ("interbank_failure", "interbank_out_failed"):
    mart(_name, "txn", "transaction_date", f"(SELECT * FROM txn WHERE {IN3} AND partners = 'NIPCREDIT' AND response_code <> '00') x", CH, O, money=CHM)
WDL = f"(SELECT * FROM txn WHERE {IN3} AND type_enum = 2 AND response_code IN ('00', '201', '200', '9000')) x"
mart("avg_customer_transfers", "txn", "transaction_date", WDL,
     "count(DISTINCT client_id) AS total_customers, count(*) // count(DISTINCT client_id) AS avg_transactions_per_customer", O)
mart("interbank_out", "txn", "transaction_date", f"(SELECT * FROM txn WHERE ({IN3} OR channel IS NULL) AND partners = 'NIPCREDIT' AND response_code = '00') x",
     f"count(CASE WHEN channel IS NULL THEN 1 END) AS null_volume, {CH}", O, money=CHM)
mart("cardless", "txn", "transaction_date", f"(SELECT * FROM txn WHERE {IN3} AND partners = 'CARDLESS' AND response_code = '00') x", CH, O, money=CHM)
mart("bills_by_channel", "bill_only", "transaction_date", f"(SELECT * FROM bill_only WHERE transaction_status = 'success' AND {IN3}) x", CH, O, money=CHM)
mart("bills", "bill_only", "transaction_date", "(SELECT * FROM bill_only WHERE transaction_status = 'success') x", "count(*) AS biller_count", O, "biller")
mart("airtime_by_channel", "bill_item", "transaction_date", f"(SELECT * FROM {AIRTIME} WHERE transaction_status = 'success' AND {IN3}) x", CH, O, money=CHM)
mart("airtime", "bill_item", "transaction_date", f"(SELECT * FROM {AIRTIME} WHERE transaction_status = 'success') x", "count(*) AS biller_count", O, "biller")
_cards, _cards_money = [], []
for _kind, _short in (("cashWithdrawal", "atm"), ("debitGoodsAndServices", "pos"), ("paymentFromAccount", "web"), ("accountTransfer", "transfer")):
    _cards.append(f"count(CASE WHEN transaction_type = '{_kind}' THEN 1 END) AS {_short}_volume, coalesce(sum(CASE WHEN transaction_type = '{_kind}' THEN amount END), 0) AS {_short}_value")
    _cards_money.append(f"{_short}_value")
mart("cards", "card_txn", "transaction_date", "(SELECT * FROM card_txn WHERE transaction_status = 'success') x",
     ", ".join(_cards) + ", count(*) AS total_volume, sum(amount) AS total_value", O, money=" ".join([*_cards_money, "total_value"]))
mart("account_product_txn", "txn", "transaction_date", WDL, CH, O, "product_name", money=CHM)
FD = "(SELECT * FROM txn WHERE is_reversed = 'No' AND product_id = 36 AND type_enum = 1 AND client_id IN (SELECT client_id FROM account WHERE product_id IN {p})) x"
mart("fd_corporate", "txn account", "transaction_date", FD.format(p="(26)"), "sum(amount) AS fd_amount", O, money="fd_amount")
mart("fd_retail", "txn account", "transaction_date", FD.format(p="(29, 31, 33)"), "sum(amount) AS fd_amount", O, money="fd_amount")
mart("product_liquidation", "txn", "transfer_date",
     f"(SELECT * FROM {TRANSFER} tr JOIN {LEGS} l ON l.leg_id = tr.to_txn OR l.leg_id = tr.from_txn WHERE description ILIKE '%liq%') x", VV, O, "product_name", money="value")
mart("corporate_txn", "txn", "transaction_date", "(SELECT * FROM txn WHERE is_reversed = 'No' AND product_id = 26) x",
     """count(CASE WHEN type_enum = 2 THEN 1 END) AS debit_volume, count(CASE WHEN type_enum = 1 THEN 1 END) AS credit_volume,
 coalesce(sum(CASE WHEN type_enum = 2 THEN amount END), 0) AS debit_value, coalesce(sum(CASE WHEN type_enum = 1 THEN amount END), 0) AS credit_value""", O,
     money="debit_value credit_value")
mart("voucher", "txn", "transaction_date",
     "(SELECT *, replace(replace(replace(third_party_name, 'VOUCHER|', ''), '|429', ''), '|133', '') AS voucher FROM txn WHERE partners = 'VOUCHER' AND response_code = '00') x",
     VV, O, "voucher", money="value")
mart("qr_code", "card_txn", "transaction_date", "(SELECT *, transaction_type AS qr_type FROM card_txn) x", VV, O, "qr_type, transaction_status", money="value")
mart("business_payment", "txn", "transaction_date", "(SELECT * FROM txn WHERE partners = 'TRANSFER' AND response_code = '00') x", VV, O, money="value")
mart("loans", "loan", "disbursedon_date", "loan", """sum(principal_disbursed) AS total_principal_disbursed, sum(total_expected_repayment) AS total_expected_repayment,
 sum(interest_charged) AS total_interest_charged, sum(principal_repaid) AS total_principal_repaid""", O,
     money="total_principal_disbursed total_expected_repayment total_interest_charged total_principal_repaid")
STATUS = """count(CASE WHEN {c} = '00' THEN 1 END) AS success_volume, count(CASE WHEN {c} <> '00' THEN 1 END) AS failed_volume,
 coalesce(sum(CASE WHEN {c} = '00' THEN amount END), 0) AS success_value, coalesce(sum(CASE WHEN {c} <> '00' THEN amount END), 0) AS failed_value"""
mart("pos", "pos", "transaction_date", "pos", STATUS.format(c="status_code"), O, money="success_value failed_value")
TERMINAL = "(SELECT * FROM wallet WHERE wallet_name ILIKE '%supplier#%7%') x"
mart("terminal_wallet", "wallet", "time", TERMINAL, VV, O, money="value")
mart("terminal_wallet_status", "wallet", "time", TERMINAL, STATUS.format(c="transaction_response"), O, money="success_value failed_value")
for _dir in ("outflow", "inflow"):
    mart(f"wallet_{_dir}", "wallet", "time",
         f"(SELECT * FROM wallet WHERE {KEPT} AND transaction_response = '00' AND transaction_type = '{_dir.upper()}') x", FLOWS, O, money="intra_value inter_value")
mart("wallet_loans", "wallet", "time", "(SELECT * FROM wallet WHERE transaction_type = 'INITIAL INFLOW' AND transaction_response = '00') x", VV, O, money="value")
_CALLS = CALLS.removeprefix("calls AS ")
mart("api_calls", "api", "x.date", f"{_CALLS} x", "count(*) AS calls", E, "subscriber, resource_consumed")
mart("message_charges", "api", "x.date", "api x", "count(*) AS messages, sum(amount) AS hold_amount", E, money="hold_amount")

def quota(fmt: str, period: str, party: str, free: int, condition: str) -> str:
    """Each party's movements of a period in order; the first ``free`` of them cost nothing."""
    return f"""
SELECT {period}, count(*) AS total_transfers, count(*) FILTER (nth <= {free}) AS free_transfers, count(*) FILTER (nth > {free}) AS additional_transfers
FROM (SELECT strftime(transaction_date, '{fmt}') AS {period}, row_number() OVER (PARTITION BY {party}, strftime(transaction_date, '{fmt}') ORDER BY transaction_id) AS nth
  FROM txn WHERE type_enum = 2 AND response_code = '00' AND {condition}) GROUP BY 1"""


for _suffix, _fmt, _cond in (
    ("monthly", "%Y-%m", "strftime(transaction_date, '%Y-%m') < '2001-08'"),
    ("daily", "%Y-%m-%d", "year(transaction_date) = 2001 AND CAST(transaction_date AS DATE) <= DATE '2001-08-02'"),
):
    _period = "month" if _suffix == "monthly" else "date"
    for _item, _views, _src in (("biller", "bill_only", "bill_only"), ("airtime", "bill_item", AIRTIME)):
        sql(f"top_{_item}_{_suffix}", _views, f"""
WITH c AS (SELECT strftime(transaction_date, '{_fmt}') AS {_period}, biller, count(*) AS biller_count FROM {_src} AS s
  WHERE transaction_status = 'success' AND {_cond} GROUP BY 1, 2)
--main SELECT * FROM c WHERE biller_count = (SELECT max(x.biller_count) FROM c x WHERE x.{_period} = c.{_period})""")
    sql(f"free_vs_extra_quota_{_suffix}", "txn", quota(_fmt, _period, "client_id", 50, f"{_cond} AND {IN3} AND partners = 'NIPCREDIT'"),
        whole="total_transfers free_transfers additional_transfers")

sql("free_vs_extra_quota_ytd", "txn", quota("%Y-%m-%d", "date", "channel", 3, "year(transaction_date) = 2001 AND transaction_date < DATE '2001-08-03'"),
    whole="total_transfers free_transfers additional_transfers")
for _block, _mart in (
    ("channel_volume_value_monthly", "intrabank_monthly"), ("channel_volume_value_ytd", "intrabank_ytd"),
    ("tier_counts_monthly", "retail_tier_monthly"), ("card_status_monthly", "card_status_monthly"),
    ("card_type_monthly", "cards_monthly"), ("success_fail_monthly", "pos_monthly"),
    ("fd_value_corporate", "fd_corporate_monthly"), ("fd_value_retail", "fd_retail_monthly"),
):
    ORACLE[_block] = ORACLE[f"mart_{_mart}"]
sql("free_vs_extra_quota", "txn", quota("%Y-%m", "month", "client_id", 1, "strftime(transaction_date, '%Y-%m') < '2001-08'"),
    whole="total_transfers free_transfers additional_transfers")
sql("mart_gender_totals", "client", """
SELECT CASE gender_code WHEN '29' THEN 'male' ELSE 'female' END AS gender, count(DISTINCT client_id) AS customers FROM client WHERE gender_code IS NOT NULL GROUP BY 1""")
sql("mart_bill_buyers", "bill_only", "SELECT count(DISTINCT o_custkey) AS purchase_bill_customers FROM bill_only JOIN orders ON o_orderkey = order_id")
sql("mart_airtime_buyers", "bill_item", f"SELECT count(DISTINCT o_custkey) AS purchase_airtime_customers FROM {AIRTIME} a JOIN orders ON o_orderkey = order_id")
sql("loan_daily_spine", "loan schedule payment", """
SELECT d.date, coalesce(a, 0) AS total_disbursed, coalesce(b, 0) AS expected_repayment, coalesce(c, 0) AS actual_repayment
FROM (SELECT CAST(range AS DATE) AS date FROM range(TIMESTAMP '2000-01-01', TIMESTAMP '2001-08-02', INTERVAL '1 day')) d
LEFT JOIN (SELECT CAST(disbursedon_date AS DATE) AS date, sum(principal_disbursed) AS a FROM loan GROUP BY 1) x ON x.date = d.date
LEFT JOIN (SELECT duedate AS date, sum(principal_amount + interest_amount) AS b FROM schedule GROUP BY 1) y ON y.date = d.date
LEFT JOIN (SELECT transaction_date AS date, sum(amount) AS c FROM payment GROUP BY 1) z ON z.date = d.date""",
    money="total_disbursed expected_repayment actual_repayment", date="date")

# -- alerts ------------------------------------------------------------------------------------------------------------

sql("limit_band_alerts", "api", """
WITH r AS (SELECT CAST(date AS DATE) AS day, date AS ts, id, sum(amount) OVER (PARTITION BY CAST(date AS DATE) ORDER BY date, id ROWS UNBOUNDED PRECEDING) AS used FROM api),
b AS (SELECT *, CAST(floor(used * 10 / 10000) * 10 AS INTEGER) AS band FROM r)
--main SELECT day AS date, band, ts AS reached_at, id AS event_id, used AS amount_used
FROM (SELECT *, row_number() OVER (PARTITION BY day, band ORDER BY ts, id) AS n FROM b WHERE band >= 50 AND band < 100) WHERE n = 1""",
    money="amount_used", date="date", ts="reached_at", whole="band")
POSITION = f"""p AS (SELECT count(*) FILTER (side = 'out') AS out_volume, count(*) FILTER (side = 'in') AS in_volume, sum(amount) FILTER (side = 'out') AS out_value,
  sum(amount) FILTER (side = 'in') AS in_value, min(date) FILTER (side = 'out') AS out_start, max(date) FILTER (side = 'out') AS out_end
  FROM (SELECT *, CASE resource WHEN '/purchase' THEN 'out' ELSE 'in' END AS side FROM api WHERE resource IN ('/purchase', '/signup')
    AND date >= TIMESTAMP '2024-01-25 14:00:00' AND date < TIMESTAMP '2024-01-29 10:30:00')),
q AS (SELECT *, out_value - in_value AS difference, 20000 AS threshold, 20000 - (out_value - in_value) AS threshold_balance,
  {_percent("out_value - in_value", "20000")} AS percent_consumption FROM p)"""
sql("settlement_position", "api", f"WITH {POSITION} --main SELECT *, percent_consumption >= 50 AS alert FROM q",
    money="out_value in_value difference threshold_balance", ts="out_start out_end", whole="threshold")
sql("settlement_text", "api", f"""WITH {POSITION} SELECT format('{{:,}}', out_volume) AS out_volume, format('{{:,}}', in_volume) AS in_volume,
  'N ' || format('{{:,.2f}}', CAST(out_value AS DOUBLE)) AS out_value, 'N ' || format('{{:,.2f}}', CAST(in_value AS DOUBLE)) AS in_value,
  'N ' || format('{{:,.2f}}', CAST(difference AS DOUBLE)) AS difference, 'N ' || format('{{:,.2f}}', CAST(threshold AS DOUBLE)) AS threshold,
  'N ' || format('{{:,.2f}}', CAST(threshold_balance AS DOUBLE)) AS threshold_balance, format('{{:,.2f}}', percent_consumption) || '%' AS percent_consumption FROM q""")


# -- streams: the batch result over all rows -----------------------------------------------------------------------------

sql("stream_incremental_append", "", "SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS amount FROM events", money="amount", ts="ts")
sql("stream_tumbling_10min", "", """
SELECT time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '2024-01-01') AS slice_start, event_type, count(*) AS lines, sum(CAST(value AS DECIMAL(18,2))) AS amount
FROM events GROUP BY 1, 2""", money="amount", ts="slice_start")
ORACLE["stream_limit_band_alerts"] = ORACLE["limit_band_alerts"]
sql("stream_settlement_cycles", "", """
WITH moved AS (SELECT *, CAST(ts - INTERVAL '14 hours' AS DATE) AS on_day, CAST(value AS DECIMAL(18,2)) AS amount FROM events WHERE event_type IN ('purchase', 'signup')),
open_days AS (SELECT CAST(range AS DATE) AS d FROM range(TIMESTAMP '2023-12-01', TIMESTAMP '2024-02-11', INTERVAL '1 day')
  WHERE isodow(range) < 6 AND CAST(range AS DATE) NOT IN (DATE '2024-01-01', DATE '2024-01-26'))
--main SELECT cycle_start, count(*) FILTER (event_type = 'purchase') AS out_volume, count(*) FILTER (event_type = 'signup') AS in_volume,
  sum(amount) FILTER (event_type = 'purchase') AS out_value, sum(amount) FILTER (event_type = 'signup') AS in_value
FROM (SELECT moved.*, (SELECT max(d) FROM open_days WHERE d <= on_day) + INTERVAL '14 hours' AS cycle_start FROM moved) GROUP BY 1""",
    money="out_value in_value", ts="cycle_start")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
