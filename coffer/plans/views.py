"""The test tables seen as a bank: clients, accounts, transactions, bills, wallets, loans, cards, journal.

Each view is a narrow projection of one table, so a query that needs three columns of ``transaction`` still reads only
the columns behind those three. Names of parties (billers, wallets) are tables of their own and joined where a report
shows them, after aggregation. ``oracle_views`` holds the same definitions as SQL for the checks.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2001, 8, 2)          # orders and lineitem run to about here
CLIENT_AS_OF = dt.date(1994, 10, 15)  # activation dates fill 1994
EVENT_AS_OF = dt.date(2024, 1, 31)
EVENT_MART_AS_OF = dt.date(2024, 2, 10)  # the events fill January

PRODUCTS = (
    (33, "Universal Savings Account"),
    (36, "Term Fixed Deposit"),
    (26, "Corporate Current Account"),
    (24, "Child Savings"),
    (30, "Target Savings Account"),
    (29, "Individual Current Account"),
    (31, "Staff Current Account"),
)
RETAIL_PRODUCTS = (29, 31, 33)
FIXED_DEPOSIT = 36
CORPORATE = 26
APP_USER = 31

# Biller codes as merchants write them: at least one for each mark of the biller and airtime rules, and some for none.
MERCHANT_CODES = (
    "GOtv max", "bet 9ja", "BET9JA", "SportyBet", "sporty bet ng", "Ikeja prepaid", "IKEDC prepaid", "DSTV", "Abuja AEDC",
    "EKO disco", "EKEDC", "Ibadan disco", "ibedc", "BetKing", "bet king", "1xbet", "1X BET", "StarTimes", "star times",
    "Smile data", "NairaBet", "Enugu disco", "EEDC", "Xbox gift", "MerryBet", "merry bet", "Swift net", "Benin disco",
    "BEEDC", "Google card", "BetWay", "bet way", "IPNX fibre", "Sony PlayStation", "Amazon card", "Spotify", "BangBet",
    "bang bet", "PortHarcourt disco", "PHEDC", "PEDC", "Kaduna disco", "TStv", "Arik air", "Kano disco", "AXA health",
    "NaijaBet", "Winners Chapel", "Spectranet", "MLotto", "Winners Golden Chance", "WGB", "Flexi net", "mtn vtu",
    "Airtel data", "glo topup", "9mobile", "Blank", "City library fine of the year 2001, second notice", "Toll gate",
)

# Declared schemas: a read then needs no job over file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

_PRODUCT_ID = "element_at(array({}), cast({{a}} % 7 as int) + 1)".format(", ".join(str(p) for p, _ in PRODUCTS))
_PRODUCT_NAME = "element_at(array({}), cast({{a}} % 7 as int) + 1)".format(", ".join(f"'{n}'" for _, n in PRODUCTS))
_ACCOUNT_NO = "concat('10', lpad(cast({a} as string), 8, '0'))"
# Unique in the test data; order and line number alone are not, see ``pooled_id``.
_LINE_ID = "(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + cast(l_quantity as bigint)"
_SETTLED = ("cast(round(cast(l_extendedprice as decimal(18,2)) * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2))), 2)"
            " as decimal(18,2))")


class Bank:
    """Conformed tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # -- parties -------------------------------------------------------------------------------------------------

    @cached_property
    def client(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as client_id",
            "c_name as client_name",
            "c_mktsegment as client_category",
            "concat('Tier ', 1 + c_custkey % 3) as client_tier",
            "cast(99 + c_custkey % 3 as string) as level_code",
            "if(c_custkey % 20 = 0, '600', '300') as status_code",
            "if(c_custkey % 20 = 0, 'Closed', 'Active') as client_status",
            "case when c_custkey % 13 <> 0 then if(c_custkey % 2 = 0, '29', '30') end as gender_code",
            "cast(64 + c_custkey % 3 as string) as type_code",
            "cast(60 + c_custkey % 5 as string) as marital_code",
            "date_add(date'1994-01-01', cast(c_custkey % 365 as int)) as activation_date",
            "case when c_custkey % 20 = 0 then date_add(date'1996-01-01', cast(c_custkey % 1500 as int)) end as closedon_date",
            "case when c_custkey % 4 <> 0 then c_custkey % 50 end as referred_by_id",
            "case when c_custkey % 11 <> 0 then concat('01-01-', 1940 + c_custkey % 80) end as dob_text",
            "case when c_custkey % 5 <> 0 then c_custkey + 1 end as image_id",
            f"if(c_custkey % 3 <> 0, {APP_USER}, 7) as activatedon_userid",
            "cast(50000 * (1 + c_custkey % 3) as decimal(18,2)) as daily_withdraw_limit",
            "cast(20000 * (1 + c_custkey % 5) as decimal(18,2)) as max_transaction_limit",
            "element_at(array('MobileApp', 'WhatsApp', 'Backend', 'MobileApp'), cast(c_custkey % 4 as int) + 1) as onboard_channel",
            "concat('080', lpad(cast(c_custkey as string), 8, '0')) as mobile_number",
            "cast(c_acctbal as decimal(18,2)) as net_position",
            "c_nationkey as state_id",
        )

    @cached_property
    def state(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey as state_id", "n_name as state")

    @cached_property
    def account(self) -> DataFrame:
        """Two accounts per client; the second starts 2,000 below the first."""
        slots = self.table("customer").selectExpr("c_custkey", "c_acctbal", "c_nationkey", "explode(array(0, 1)) as slot")
        numbered = slots.selectExpr("*", "c_custkey * 2 + slot as account_id")
        return numbered.selectExpr(
            "account_id",
            "c_custkey as client_id",
            f"{_ACCOUNT_NO.format(a='account_id')} as account_no",
            f"{_PRODUCT_ID.format(a='account_id')} as product_id",
            f"{_PRODUCT_NAME.format(a='account_id')} as product_name",
            "date_add(date'1994-01-01', cast(c_custkey % 365 + 30 * slot as int)) as approvedon_date",
            "case when account_id % 9 = 0 then date_add(date'2000-06-01', cast(account_id % 400 as int)) end as closedon_date",
            f"if(account_id % 5 = 0, 7, {APP_USER}) as submittedby_userid",
            "cast(c_acctbal - 2000 * slot as decimal(18,2)) as balance",
            "cast(5000 + 1000 * (account_id % 5) as decimal(18,2)) as overdraft_limit",
            f"case when account_id % 3 = 0 then date_sub(date'{AS_OF}', cast(account_id % 200 as int)) end as overdraft_start",
            f"case when account_id % 3 = 0 then date_add(date'{AS_OF}', cast(account_id % 100 as int) - 5) end as overdraft_end",
            "case when account_id % 10 = 9 then cast(9000000 + c_nationkey as bigint) end as group_id",
        )

    @cached_property
    def product(self) -> DataFrame:
        rows = ", ".join(f"({pid}, '{name}')" for pid, name in PRODUCTS)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(product_id, product_name)")

    # -- movements -----------------------------------------------------------------------------------------------

    @cached_property
    def transaction(self) -> DataFrame:
        numbered = self.table("orders").selectExpr(
            "o_orderkey as k", "o_custkey as cust", "o_custkey * 2 + o_orderkey % 2 as account_id", "o_totalprice",
            "o_orderdate", "o_orderstatus", "o_orderpriority",
        )
        return numbered.selectExpr(
            "k as transaction_id",
            "cust as client_id",
            "account_id",
            f"{_ACCOUNT_NO.format(a='account_id')} as account_no",
            f"{_PRODUCT_ID.format(a='account_id')} as product_id",
            f"{_PRODUCT_NAME.format(a='account_id')} as product_name",
            "cast(o_totalprice as decimal(18,2)) as amount",
            "o_orderdate as transaction_date",
            "if(o_orderstatus = 'F', 2, 1) as type_enum",
            "if(o_orderstatus = 'F', 'withdrawal', 'deposit') as transaction_type",
            "case left(o_orderpriority, 1) when '1' then 'MOBILE' when '2' then 'USSD' when '3' then 'CHATBOT'"
            " when '4' then 'WALLET' end as channel",
            "if(k % 7 = 0, '91', '00') as response_code",
            "element_at(array('INTERNAL', 'NIPCREDIT', 'CARDLESS', 'VOUCHER', 'BILLS', 'TRANSFER'), cast(k % 6 as int) + 1) as partners",
            "if(k % 6 = 0, 'Internal transfer', 'External transfer') as partners_description",
            "if(k % 25 = 0, 'Yes', 'No') as is_reversed",
            "case k % 8 when 0 then 'FD Booking' when 1 then 'Roll over' when 2 then 'Loan Disbursement'"
            " when 3 then 'Partial Liquidation' when 4 then concat('Reversal Of transactionId ', k - 1)"
            " else concat('Transfer to ', cust % 100) end as remarks",
            "case when k % 6 = 3 then concat('VOUCHER|item ', k % 5, if(k % 2 = 0, '|429', '|133')) end as third_party_name",
            "case when k % 3 <> 0 then concat('S', k) end as session_id",
        )

    @cached_property
    def bill(self) -> DataFrame:
        """Settled purchases, one per order line; the line's supplier is the biller."""
        return self.table("lineitem").selectExpr(
            f"{_LINE_ID} as transaction_id",
            "l_orderkey as order_id",
            "l_suppkey as biller_id",
            "l_partkey as item_id",
            "cast(l_extendedprice as decimal(18,2)) as amount",
            f"{_SETTLED} as settled_amount",
            "l_shipdate as transaction_date",
            "if(l_returnflag = 'R', 'failed', 'success') as transaction_status",
            "element_at(array('MOBILE', 'USSD', 'CHATBOT', 'WALLET'), l_linenumber % 4 + 1) as channel",
        )

    @cached_property
    def biller(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey as biller_id", "s_name as biller")

    @cached_property
    def order_owner(self) -> DataFrame:
        return self.table("orders").selectExpr("o_orderkey as order_id", "o_custkey as client_id")

    @cached_property
    def bill_item(self) -> DataFrame:
        """Purchases with the biller code text: the part name, 'Blank' for every part type SMALL."""
        part = self.table("part").selectExpr(
            "p_partkey as item_id",
            "if(p_type = 'SMALL', 'Blank', upper(p_name)) as biller_code",
            "concat_ws(' ', p_type, p_name, p_brand) as remarks",
        )
        return self.bill.join(part, "item_id", "left")

    @cached_property
    def bill_only(self) -> DataFrame:
        """Purchases that are not airtime; the fixture's item names hold no brand, so the part's colour stands for one."""
        return self.bill_item.filter("not coalesce(biller_code rlike 'RED|BLUE', false)")

    @cached_property
    def airtime(self) -> DataFrame:
        return self.bill_item.filter("biller_code rlike 'RED|BLUE'")

    @cached_property
    def branded_item(self) -> DataFrame:
        """Purchases with the biller code as merchants write it: the item decides which of ``MERCHANT_CODES``."""
        codes = ", ".join(f"'{c}'" for c in MERCHANT_CODES)
        return self.bill_item.drop("biller_code").selectExpr(
            "*", f"element_at(array({codes}), cast(item_id % {len(MERCHANT_CODES)} as int) + 1) as biller_code"
        )

    @cached_property
    def wallet_txn(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{_LINE_ID} as transaction_id",
            "l_orderkey as order_id",
            "l_suppkey as wallet_id",
            "case when l_linestatus = 'F' and l_linenumber = 7 then 'INITIAL INFLOW' when l_linestatus = 'O' then 'OUTFLOW'"
            " else 'INFLOW' end as transaction_type",
            "concat('20', lpad(cast(l_partkey % 1000 as string), 8, '0')) as from_account_no",
            "concat('20', lpad(cast(l_suppkey as string), 8, '0')) as to_account_no",
            "cast(l_partkey % 25 as int) as from_bank",
            "if(l_suppkey % 2 = 0, '999999', '000013') as to_bank",
            "cast(l_extendedprice as decimal(18,2)) as amount",
            "if(l_returnflag = 'R', '99', '00') as transaction_response",
            "concat(l_orderkey, '-', l_linenumber) as statement_ids",
            "l_shipdate as time",
            "concat('S', l_orderkey) as session_id",
            "l_orderkey * 10 + l_linenumber as pooled_id",
        )

    @cached_property
    def wallet(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey as wallet_id", "s_name as wallet_name")

    @cached_property
    def bank(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey as bank_code", "concat('BANK ', n_name) as bank_name")

    @cached_property
    def pos_txn(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{_LINE_ID} as transaction_id",
            "l_orderkey as order_id",
            "l_suppkey as merchant_id",
            "concat('T', lpad(cast(l_suppkey % 500 as string), 6, '0')) as terminal_id",
            "if(l_returnflag = 'R', '51', '00') as status_code",
            "cast(l_extendedprice as decimal(18,2)) as amount",
            f"{_SETTLED} as settled_amount",
            "concat('506101', lpad(cast(l_partkey as string), 10, '0')) as card_pan",
            "l_shipdate as transaction_date",
            f"{_ACCOUNT_NO.format(a='(l_suppkey * 3)')} as account_no",
        )

    @cached_property
    def api_call(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id as id",
            "concat('user-', user_id) as subscriber",
            "concat('/', event_type) as resource",
            "if(event_id % 4 = 0, concat('acct/', event_id), props) as resource_value",
            "if(event_type = 'error', 'Fail', 'Success') as response_status",
            "ts as date",
            "cast(value as decimal(18,2)) as amount",
        )

    # -- credit, deposits, cards ---------------------------------------------------------------------------------

    @cached_property
    def loan(self) -> DataFrame:
        priced = self.table("orders").filter("o_orderpriority = '1-URGENT'").selectExpr(
            "*", "cast(o_totalprice as decimal(18,2)) as principal", "o_orderstatus = 'F' as done",
        )
        interest = "cast(round(principal * cast(0.05 as decimal(4,2)), 2) as decimal(18,2))"
        return priced.selectExpr(
            "o_orderkey as loan_id",
            "o_custkey as client_id",
            "cast(o_orderkey % 4 as int) as product_id",
            "if(done, 600, 300) as loan_status_id",
            "principal as principal_disbursed",
            "if(done, principal, cast(0 as decimal(18,2))) as principal_repaid",
            f"{interest} as interest_charged",
            f"cast(principal + {interest} as decimal(18,2)) as total_expected_repayment",
            "o_orderdate as disbursedon_date",
            "case when done then date_add(cast(o_orderdate as date), 180) end as closedon_date",
            "cast(o_orderkey % 5 as int) as purpose_id",
            "cast(o_orderkey % 3 + 10 as int) as collateral_id",
            "cast(o_orderkey % 7 as int) as officer_id",
            "cast(o_orderkey % 5 + 2 as int) as approver_id",
        )

    @cached_property
    def schedule(self) -> DataFrame:
        """Instalments of the loans: the lines of the orders that are loans."""
        lines = self.table("lineitem").selectExpr(
            "l_orderkey as loan_id",
            "cast(l_shipdate as date) as duedate",
            "cast(l_extendedprice as decimal(18,2)) as principal_amount",
            "cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)), 2) as decimal(18,2)) as interest_amount",
            "l_returnflag as flag",
        )
        return lines.join(self.loan.select("loan_id"), "loan_id", "left_semi")

    @cached_property
    def payment(self) -> DataFrame:
        return self.schedule.filter("flag = 'R'").selectExpr(
            "loan_id", "duedate as transaction_date", "principal_amount as amount"
        )

    @cached_property
    def code_value(self) -> DataFrame:
        """One lookup table for all loan codes, as (code_name, code_id, label)."""
        return self.spark.sql(
            "SELECT * FROM VALUES "
            "('status', 300, 'Active'), ('status', 600, 'Closed'), "
            "('purpose', 0, 'Rent'), ('purpose', 1, 'School'), ('purpose', 2, 'Trade'), ('purpose', 3, 'Health'), "
            "('collateral', 10, 'None'), ('collateral', 11, 'Vehicle'), ('collateral', 12, 'Property'), "
            "('product', 0, 'Salary loan'), ('product', 1, 'Trade loan'), ('product', 2, 'Overdraft'), "
            "('product', 3, 'Asset loan') AS t(code_name, code_id, label)"
        )

    @cached_property
    def staff_user(self) -> DataFrame:
        return self.spark.sql(
            "SELECT * FROM VALUES (0, 'u.zero'), (1, 'u.one'), (2, 'u.two'), (3, 'u.three'), (4, 'u.four'), "
            "(5, 'u.five') AS t(user_id, username)"
        )

    @cached_property
    def term_deposit(self) -> DataFrame:
        held = self.account.filter(f"product_id = {FIXED_DEPOSIT}").selectExpr(
            "account_id", "client_id", "account_no", "balance",
            "cast(30 * (1 + account_id % 12) as int) as deposit_period",
            "cast(abs(balance) as decimal(18,2)) as deposit_amount",
            "date_add(approvedon_date, 2557) as start_date",  # seven years on: the deposit runs in the year of AS_OF
        )
        return held.selectExpr(
            "account_id", "client_id", "account_no", "balance", "deposit_period", "deposit_amount",
            "cast(round(deposit_amount * cast(1.05 as decimal(4,2)), 2) as decimal(18,2)) as maturity_amount",
            "start_date", "date_add(start_date, deposit_period) as maturity_date",
        )

    @cached_property
    def card(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as card_id",
            "c_custkey as client_id",
            "if(c_custkey % 3 = 0, 'PHYSICAL', 'VIRTUAL') as pan_type",
            "element_at(array('ACTIVE', 'EXPIRED', 'BLOCKED'), cast(c_custkey % 3 as int) + 1) as card_status",
            "concat(lpad(cast(94 + c_custkey % 6 as string), 2, '0'), lpad(cast(1 + c_custkey % 12 as string), 2, '0')) as expiry_code",
            "date_add(date'1994-01-01', cast(c_custkey % 365 as int)) as date_created",
            "2 * c_custkey as account_id",
            "case when c_custkey % 7 <> 0 then cast(500 * (1 + c_custkey % 4) as decimal(18,2)) end as charge",
        )

    @cached_property
    def card_txn(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey as id",
            "o_custkey as client_id",
            "element_at(array('cashWithdrawal', 'debitGoodsAndServices', 'paymentFromAccount', 'accountTransfer'),"
            " cast(o_orderkey % 4 as int) + 1) as transaction_type",
            "cast(o_totalprice as decimal(18,2)) as amount",
            "o_orderdate as transaction_date",
            "if(o_orderstatus = 'P', 'failed', 'success') as transaction_status",
        )

    # -- ledger --------------------------------------------------------------------------------------------------

    @cached_property
    def journal(self) -> DataFrame:
        """Two legs per transaction on one of ten ledger accounts; the second leg goes to the next account."""
        legs = self.table("orders").selectExpr(
            "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "explode(array(1, 2)) as leg"
        ).selectExpr("*", "cast((o_custkey % 10 + leg - 1) % 10 as int) as gl_account_id")
        return legs.selectExpr(
            "o_orderkey * 2 + leg as entry_id",
            "o_orderkey as transaction_id",
            "gl_account_id",
            "leg as type_enum",
            "cast(o_totalprice as decimal(18,2)) as amount",
            "cast(o_orderdate as date) as entry_date",
            "1 + gl_account_id % 5 as classification_enum",
        )

    @cached_property
    def gl_account(self) -> DataFrame:
        return self.spark.range(10).selectExpr("cast(id as int) as gl_account_id", "concat('GL ', id) as gl_name")
