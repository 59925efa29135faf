"""Transactions, balances, statement lines, general ledger."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.dates import DateLike, as_date, day, on_day
from coffer.functions.measures import sum_when
from coffer.functions.text import id_head
from coffer.operators.joins import left_join_known
from coffer.operators.running import running_balance


def with_running_balance(txns: DataFrame) -> DataFrame:
    """Transactions with the account balance after each: deposits add, withdrawals take off."""
    signed = txns.withColumn("_signed", F.when(F.col("type_enum") == 1, F.col("amount")).otherwise(-F.col("amount")))
    return running_balance(signed, "account_id", "transaction_date", "transaction_id", "_signed", "running_balance").drop(
        "_signed"
    )


def with_running_balance_since(txns: DataFrame, since: DateLike, opening: DataFrame | None = None) -> DataFrame:
    """``with_running_balance`` for the movements from a day on.

    What came before is one sum per account, with map-side combine; only rows from the day on are ordered. With an ``opening``
    (account_id, closing_balance of the day before) earlier rows are not read at all.
    """
    signed = F.when(F.col("type_enum") == 1, F.col("amount")).otherwise(-F.col("amount"))
    first = day(since)
    if opening is None:
        earlier = txns.filter(F.col("transaction_date") < first)
        opening = earlier.groupBy("account_id").agg(F.sum(signed).alias("closing_balance"))
    recent = with_running_balance(txns.filter(F.col("transaction_date") >= first))
    begun = opening.select("account_id", F.col("closing_balance").alias("_opening"))
    balance = F.col("running_balance") + F.coalesce("_opening", F.lit(0).cast("decimal(28,2)"))
    return recent.join(begun, "account_id", "left").withColumn("running_balance", balance.cast("decimal(28,2)")).drop("_opening")


def balances_of(txns: DataFrame, wanted: DataFrame) -> DataFrame:
    """``with_running_balance`` for the accounts of the ``wanted`` transaction ids only; no other account is sorted."""
    accounts = txns.join(wanted, "transaction_id", "left_semi").select("account_id").distinct()
    return with_running_balance(txns.join(accounts, "account_id", "left_semi"))


def latest_running_balance(txns: DataFrame, order: Sequence[str] = ("transaction_date", "transaction_id")) -> DataFrame:
    """Balance after the last movement of each account.

    The last balance is the sum of all movements, so no ordering is needed at all: one aggregation with map-side
    combine gives it together with the id of the last movement.
    """
    signed = F.when(F.col("type_enum") == 1, F.col("amount")).otherwise(-F.col("amount"))
    last = F.max(F.struct(*order))
    return txns.groupBy("account_id").agg(F.sum(signed).alias("running_balance"), last.alias("_last")).select(
        "account_id", F.col("_last.transaction_id").alias("last_transaction_id"),
        F.col("_last.transaction_date").alias("last_transaction_date"), "running_balance",
    )


def last_per_key(df: DataFrame, key: str, order: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Columns of the last row per key, by ``max_by``."""
    rank = F.struct(*order)
    return df.groupBy(key).agg(*[F.max_by(c, rank).alias(c) for c in take])


def stored_closing_balance(txns_with_balance: DataFrame, on: DateLike) -> DataFrame:
    """Balance of each account after a day, from the running balance that its last row through that day stores.

    Unlike a sum it needs no history before the stored row, and holds where an account began with a balance.
    """
    until = txns_with_balance.filter(F.col("transaction_date") < day(on, 1))
    last = last_per_key(until, "account_id", ("transaction_date", "transaction_id"), ["running_balance"])
    return last.withColumnRenamed("running_balance", "closing_balance").withColumn("date", F.lit(as_date(on)))


def closing_balance_carried(yesterday: DataFrame, txns: DataFrame, on: DateLike) -> DataFrame:
    """Closing balances of a day from those of the day before and the movements of the day alone.

    ``yesterday``: account_id, closing_balance. Accounts without a movement keep their balance, accounts without one
    yesterday begin with their movements. The day is a filter on the scan, so history is not read.
    """
    signed = F.when(F.col("type_enum") == 1, F.col("amount")).otherwise(-F.col("amount"))
    moved = txns.filter(on_day(F.col("transaction_date"), on)).select("account_id", signed.alias("amount"))
    kept = yesterday.select("account_id", F.col("closing_balance").alias("amount"))
    return kept.unionByName(moved).groupBy("account_id").agg(F.sum("amount").alias("closing_balance")).withColumn(
        "date", F.lit(as_date(on))
    )


def _held_balances(
    accounts: DataFrame, txns: DataFrame, first: dt.date, last: dt.date, unit: str, keep: Sequence[str],
    opening: DataFrame | None = None,
) -> DataFrame:
    """Balances of a span as intervals: ``begins`` and ``until`` are the first and last ``unit`` (day or month) they hold.

    Only units in which an account moved are shuffled: movements are summed to one row per account and unit (everything
    before the span is the opening) and the balance is carried over those rows. Rows per account are bounded by the units
    of the span. With an ``opening`` (account_id, closing_balance) its balances stand for all that ``txns`` leave out.
    """
    to_unit = (lambda c: F.trunc(c, "month")) if unit == "month" else F.to_date
    before = to_unit(F.date_sub(F.lit(first), 1))
    signed = F.when(F.col("type_enum") == 1, F.col("amount")).otherwise(-F.col("amount"))
    moves = (
        txns.filter(F.col("transaction_date") < day(last, 1))
        .select("account_id", F.greatest(to_unit("transaction_date"), before).alias("date"), signed.alias("moved"))
        .groupBy("account_id", "date")
        .agg(F.sum("moved").alias("moved"))
    )
    held = accounts.filter(F.col("approvedon_date") <= F.lit(last)).select(
        "account_id", *keep, to_unit("approvedon_date").alias("since")
    )
    # a row per account, so that one that did not move has an interval too
    unmoved = held.select("account_id", before.alias("date"), F.lit(None).cast("decimal(28,2)").alias("moved"))
    if opening is not None:
        unmoved = unmoved.unionByName(opening.select("account_id", before.alias("date"), F.col("closing_balance").alias("moved")))
    per_account = Window.partitionBy("account_id").orderBy("date")
    before_next = F.add_months("next_date", -1) if unit == "month" else F.date_sub("next_date", 1)
    return (
        moves.unionByName(unmoved)
        .groupBy("account_id", "date")
        .agg(F.sum("moved").alias("moved"))
        .withColumn("closing_balance", F.sum("moved").over(per_account.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("next_date", F.lead("date").over(per_account))
        .join(held, "account_id")
        .withColumn("begins", F.greatest("date", to_unit(F.lit(first)), "since"))
        .withColumn("until", F.coalesce(before_next, to_unit(F.lit(last))))
        .filter(F.col("begins") <= F.col("until"))
        .select("account_id", *keep, "begins", "until", "closing_balance")
    )


def _spread(held: DataFrame, unit: str) -> DataFrame:
    """A row per unit that a balance holds for: in the task that has the interval, after the last shuffle."""
    units = F.sequence("begins", "until", F.expr(f"interval 1 {unit}"))
    keep = [c for c in held.columns if c not in ("begins", "until", "closing_balance")]
    return held.select(*keep, F.explode(units).alias("date"), "closing_balance")


ACCOUNT_COLUMNS = ("account_no", "product_id")


def closing_balance_daily(
    accounts: DataFrame, txns: DataFrame, start: DateLike, end: DateLike, keep: Sequence[str] = ACCOUNT_COLUMNS
) -> DataFrame:
    """Balance of each account at the end of each day from ``start`` through ``end``, with the kept account columns.

    A day without movement repeats the day before; an account that has not moved yet has a null balance.
    """
    return _spread(balance_intervals(accounts, txns, start, end, keep), "day")


def balance_intervals(
    accounts: DataFrame, txns: DataFrame, start: DateLike, end: DateLike, keep: Sequence[str] = ACCOUNT_COLUMNS,
    opening: DataFrame | None = None,
) -> DataFrame:
    """``closing_balance_daily`` without its repetitions: each balance once, with the first and last day it holds.

    ``opening`` (account_id, closing_balance): balances before the rows of ``txns``, which then need not reach back further.
    """
    return _held_balances(accounts, txns, as_date(start), as_date(end), "day", keep, opening)


def closing_balance_backfill(
    accounts: DataFrame, statements: DataFrame, snapshots: DataFrame, start: DateLike, end: DateLike,
    keep: Sequence[str] = ACCOUNT_COLUMNS,
) -> DataFrame:
    """``closing_balance_daily`` of many days from one stored snapshot and the movements since.

    ``snapshots``: account_id, closing_balance, date; the last one before ``start`` is taken, whichever that is when the query
    runs. ``statements`` is the transaction table in folders by ``year``: years after the span are left out when the query
    is planned, years before the snapshot when its date is known. Without a snapshot the whole history is read.
    """
    first, last = as_date(start), as_date(end)
    earlier = snapshots.filter(F.col("date") < F.lit(first))
    # a scalar subquery: found once, then a filter on folders and rows
    taken = earlier.agg(F.coalesce(F.max("date"), F.lit("0001-01-01").cast("date"))).scalar()
    since = statements.filter(
        (F.col("year") <= last.year) & (F.col("year") >= F.year(taken)) & (F.to_date("transaction_date") > taken)
    )
    opening = earlier.filter(F.col("date") == taken)
    return _spread(balance_intervals(accounts, since, first, last, keep, opening), "day")


def closing_balance_monthly(
    accounts: DataFrame, txns: DataFrame, start: DateLike, end: DateLike, keep: Sequence[str] = ACCOUNT_COLUMNS
) -> DataFrame:
    """Balance of each account on the last day of each month of a span that ends with a month."""
    held = _held_balances(accounts, txns, as_date(start), as_date(end), "month", keep)
    return _spread(held, "month").withColumn("date", F.last_day("date"))


def transactions_enriched(
    txns: DataFrame, clients: DataFrame, groups: DataFrame, accounts: DataFrame, settlements: DataFrame
) -> DataFrame:
    """Transactions with owner (client or group), account category and settlement channel."""
    held = accounts.select("account_id", "group_id", F.col("client_id").alias("_client"))
    named = left_join_known(held, clients.select(F.col("client_id").alias("_client"), "client_name"), "_client")
    owner = left_join_known(named, groups, "group_id").select(
        "account_id", F.coalesce("client_name", "group_name").alias("owner_name")
    )
    return (
        txns.join(owner, "account_id", "left")
        .join(settlements, "transaction_id", "left")
        .select(
            "transaction_id", "client_id", "owner_name", "account_no", "product_name", "amount", "transaction_date",
            "is_reversed", "transaction_type", "settled_channel", "settled_response",
        )
    )


def statement_lines(txns_with_balance: DataFrame) -> DataFrame:
    """Statement form: debit and credit columns, 0 where not that side, and the narration."""
    zero = F.lit(0).cast("decimal(18,2)")
    return txns_with_balance.select(
        "transaction_id",
        "session_id",
        "transaction_date",
        "account_no",
        "product_name",
        F.when(F.col("type_enum").isin(2, 4, 17, 18, 26), F.col("amount")).otherwise(zero).alias("debit"),
        F.when(F.col("type_enum").isin(1, 3), F.col("amount")).otherwise(zero).alias("credit"),
        F.coalesce("running_balance", F.lit(0)).alias("balance"),
        F.col("is_reversed").alias("reversed"),
        F.when(F.col("remarks").ilike("%stamp duty%"), "Stamp Duty").otherwise(F.col("remarks")).alias("narration"),
    )


def reversal_lines(txns: DataFrame) -> DataFrame:
    return txns.filter(F.col("remarks").ilike("%reversal of transactionid%")).select(
        "transaction_id", "account_no", "amount", F.col("remarks").alias("transaction_remark"), "transaction_date"
    )


def statement_with_reference(lines: DataFrame, wallet_txns: DataFrame) -> DataFrame:
    """Statement lines with the wallet reference of their session; one reference per session, the lowest."""
    reference = wallet_txns.groupBy("session_id").agg(F.min("transaction_id").alias("transaction_reference"))
    return left_join_known(lines, reference, "session_id")


def call_over(
    commands: DataFrame, accounts: DataFrame, txns: DataFrame, users: DataFrame, maker: str | None = None,
    on: DateLike | None = None,
) -> DataFrame:
    """Maker and checker list with account number, amount and narration looked up.

    ``maker`` (a user name) and ``on`` (the day of ``made_on``) limit the list before the lookups.
    """
    if on is not None:
        commands = commands.filter(on_day(F.col("made_on"), on))
    if maker is not None:
        users_of = users.filter(F.col("username") == maker).select(F.col("user_id").alias("maker_id"))
        commands = commands.join(users_of, "maker_id", "left_semi")
    makers = users.select(F.col("user_id").alias("maker_id"), F.col("username").alias("maker"))
    checker = users.select(F.col("user_id").alias("checker_id"), F.col("username").alias("checker"))
    return (
        commands.join(makers, "maker_id")
        .join(checker, "checker_id", "left")
        .join(accounts.select("account_id", "account_no"), "account_id", "left")
        .join(txns.select(F.col("transaction_id").alias("resource_id"), "amount", F.col("remarks").alias("narration")),
              "resource_id", "left")
        .select("command_id", "resource_id", "maker", "checker", "account_no", "amount", "narration")
    )


def gl_account_lines(journal: DataFrame, gl: DataFrame, account_id: int, the_day: DateLike) -> DataFrame:
    """Counter legs of the entries that touch one ledger account on a day, one row per entry.

    A transaction may touch the account with several legs; ``min`` over the group keeps one line per counter entry.
    """
    on = journal.filter(F.col("entry_date") == day(the_day))
    touched = on.filter(F.col("gl_account_id") == account_id).select("transaction_id")
    counter = on.filter(F.col("gl_account_id") != account_id).join(touched, "transaction_id", "left_semi")
    return (
        counter.join(gl, "gl_account_id", "left")
        .groupBy("entry_id", "entry_date", "gl_name")
        .agg(
            F.min("transaction_id").alias("transaction_id"),
            F.min(F.when(F.col("type_enum") == 1, F.col("amount")).otherwise(0)).alias("debit_amount"),
            F.min(F.when(F.col("type_enum") == 2, F.col("amount")).otherwise(0)).alias("credit_amount"),
            F.min("type_enum").alias("type_enum"),
        )
    )


def gl_opening_balance(journal: DataFrame, gl: DataFrame, the_day: DateLike) -> DataFrame:
    """Balance per ledger account of the entries before a day. Classes 1 and 5 rise by type 2, the others by type 1."""
    ones = sum_when(F.col("type_enum") == 1, "amount")
    twos = sum_when(F.col("type_enum") == 2, "amount")
    balance = F.when(F.col("classification_enum").isin(1, 5), F.col("twos") - F.col("ones")).otherwise(
        F.col("ones") - F.col("twos")
    )
    return (
        journal.filter(F.col("entry_date") < day(the_day))
        .groupBy("gl_account_id", "classification_enum")
        .agg(ones.alias("ones"), twos.alias("twos"))
        .join(gl, "gl_account_id", "left")
        .select("gl_account_id", "gl_name", "classification_enum", balance.alias("opening_balance"))
    )


def gl_entry_descriptions(journal: DataFrame, gl: DataFrame, txns: DataFrame, clients: DataFrame) -> DataFrame:
    """Journal entries with the ledger name, joined by account and client where the entry has a transaction."""
    source = txns.select("transaction_id", "account_no", "client_id", "remarks").join(
        clients.select("client_id", "client_name"), "client_id", "left"
    )
    detail = F.concat(F.col("gl_name"), F.lit("-("), F.col("account_no"), F.lit("-"), F.col("client_name"), F.lit(")"))
    return (
        journal.join(gl, "gl_account_id", "left")
        .join(source, "transaction_id", "left")
        .select("entry_id", F.coalesce(detail, F.col("gl_name")).alias("account_name"), F.col("remarks").alias("description"))
    )


def negative_balance_summary(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("balance") < 0).groupBy("product_id", "product_name").agg(
        F.sum("balance").alias("total_principal_balance"), F.count(F.lit(1)).alias("accounts")
    )


def negative_balance_accounts(
    txns: DataFrame, accounts: DataFrame, clients: DataFrame, as_of: DateLike, floor: float = -1000
) -> DataFrame:
    """Accounts whose balance after the last unreversed movement through ``as_of`` is below ``floor``."""
    moved = txns.filter((F.col("transaction_date") < day(as_of, 1)) & (F.col("is_reversed") == "No"))
    last = latest_running_balance(moved).filter(F.col("running_balance") < F.lit(floor))
    return (
        last.join(accounts.select("account_id", "account_no", "client_id", "product_name", "overdraft_limit"), "account_id")
        .join(clients.select("client_id", "client_name"), "client_id", "left")
        .select("account_id", "account_no", "client_name", F.upper("product_name").alias("product"),
                "last_transaction_id", "overdraft_limit", "running_balance")
    )


def statement_balance_by_head(statement: DataFrame, txns: DataFrame) -> DataFrame:
    """Wallet rows with the ledger balance after the first id in their id list; only accounts with such an id are balanced."""
    headed = statement.withColumn("head_id", id_head(F.col("statement_ids")))
    wanted = headed.select(F.expr("try_cast(head_id as bigint)").alias("transaction_id")).filter("transaction_id is not null").distinct()
    balances = balances_of(txns, wanted).join(wanted, "transaction_id", "left_semi").select(
        F.col("transaction_id").cast("string").alias("head_id"), F.col("running_balance").alias("balance")
    )
    return left_join_known(headed, balances, "head_id")


def monthly_balance_totals(daily: DataFrame) -> DataFrame:
    """Sum and non-zero count of balances on the last day of each month in the table."""
    return (
        daily.filter(F.col("date") == F.last_day("date"))
        .groupBy("date")
        .agg(F.sum("closing_balance").alias("total_balance"),
             F.count(F.when(F.col("closing_balance") != 0, 1)).alias("nonzero_accounts"))
    )


def _days_by_month(held: DataFrame) -> DataFrame:
    """Balance intervals cut at month ends: the month (its first day) and the days held in it."""
    months = F.sequence(F.trunc("begins", "month"), F.trunc("until", "month"), F.expr("interval 1 month"))
    cut = held.withColumn("month_start", F.explode(months))
    from_day, to_day = F.greatest("begins", "month_start"), F.least("until", F.last_day("month_start"))
    return cut.withColumn("days", F.datediff(to_day, from_day) + 1)


def _mean_by_days() -> Column:
    """Mean of known balances, each as often as the days it holds."""
    known = F.when(F.col("closing_balance").isNotNull(), F.col("days"))
    return F.sum(F.col("closing_balance") * F.col("days")).cast("double") / F.sum(known)


def average_balance_by_month(held: DataFrame, keys: Sequence[str] = ("account_no",)) -> DataFrame:
    """Mean daily balance per key and month, from ``balance_intervals``. Days without a known balance do not count.

    A balance weighs as many days as it holds; there is no row per day.
    """
    return _days_by_month(held).groupBy(*keys, F.date_format("month_start", "yyyy-MM").alias("month")).agg(
        _mean_by_days().alias("avg_balance")
    )


def average_balance_wide(held: DataFrame, keys: Sequence[str], months: Sequence[str]) -> DataFrame:
    """Mean daily balance per key with one column per month of a given list (``yyyy-MM``), from ``balance_intervals``."""
    return (
        _days_by_month(held).withColumn("month", F.date_format("month_start", "yyyy-MM"))
        .groupBy(*keys)
        .pivot("month", list(months))
        .agg(_mean_by_days().alias("avg"))
        .withColumnsRenamed({m: f"avg_balance_{m.replace('-', '_')}" for m in months})
    )


def as_intervals(daily: DataFrame) -> DataFrame:
    """A stored table of daily balances as intervals of a day each, for the means above."""
    return daily.withColumns({"begins": F.col("date"), "until": F.col("date")}).drop("date")


def long_to_wide_balances(daily: DataFrame, key: str, days: Sequence[DateLike]) -> DataFrame:
    """One row per key with one column per day of a given list, named ``yyyy_MM_dd``."""
    names = [as_date(d).strftime("%Y_%m_%d") for d in days]
    wide = daily.withColumn("_day", F.date_format("date", "yyyy_MM_dd")).groupBy(key).pivot("_day", names)
    return wide.agg(F.max("closing_balance"))


def wide_to_long_balances(wide: DataFrame, account: str = "account_no") -> DataFrame:
    """A balance table with one column per day as (account, date, balance). Column names are dates, ``yyyy_MM_dd``."""
    days = [c for c in wide.columns if c != account]
    return wide.unpivot([account], days, "day", "balance").select(
        account, F.to_date("day", "yyyy_MM_dd").alias("date"), "balance"
    )
