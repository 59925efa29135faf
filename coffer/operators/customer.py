"""Customer analytics: RFM, activity, demographics, adoption."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions import bands
from coffer.functions.dates import DateLike, as_date, day, month_boundaries, years_back
from coffer.functions.text import rfm_segment
from coffer.operators.quantiles import attach_one_row, exact_quantiles, score_ascending, score_descending

QUINTILES = (0.2, 0.4, 0.6, 0.8)


def rfm_base(
    clients: DataFrame,
    txns: DataFrame,
    as_of: DateLike,
    categories: Sequence[str] | None = None,
    accounts: DataFrame | None = None,
    match_reference: bool = False,
    months: int = 12,
) -> DataFrame:
    """Frequency, monetary value, recency and age in days of each active client over the last ``months``.

    Counts each transaction once. ``match_reference=True`` repeats it once per account of the client (a join on client
    id alone, without any account column in the result); that is done by counting accounts first, so the repeated rows
    are never made.
    """
    since = years_back(as_of, months)
    moves = (
        txns.filter(F.col("type_enum").isin(1, 2) & (F.col("transaction_date") >= F.lit(since)))
        .groupBy("client_id")
        .agg(
            F.count(F.lit(1)).alias("frequency"),
            F.sum("amount").alias("monetary"),
            F.max("transaction_date").cast("date").alias("last_date"),
        )
    )
    active = clients.filter(F.col("client_status") == "Active")
    if categories is None:
        active = active.filter(F.col("client_category") != "Unclassified")
    else:
        active = active.filter(F.col("client_category").isin(list(categories)))
    base = moves.join(active.select("client_id", "client_category", "activation_date"), "client_id")
    if match_reference:
        if accounts is None:
            raise ValueError("match_reference needs the accounts")
        held = accounts.groupBy("client_id").agg(F.count(F.lit(1)).alias("held"))
        base = base.join(held, "client_id", "left")
        times = F.coalesce("held", F.lit(1))
        base = base.withColumn("frequency", F.col("frequency") * times).withColumn("monetary", F.col("monetary") * times)
    return base.select(
        "client_id",
        "client_category",
        "frequency",
        "monetary",
        F.datediff(day(as_of), "last_date").alias("recency"),
        F.datediff(day(as_of), "activation_date").alias("age_days"),
        day(as_of).alias("run_date"),
    )


def rfm_quintiles(base: DataFrame) -> DataFrame:
    """One row per quintile: probability and the three cut points."""
    cuts = exact_quantiles(base, ["recency", "frequency", "monetary"], QUINTILES)
    rows = F.arrays_zip(F.array(*[F.lit(p) for p in QUINTILES]).alias("prob"), "recency", "frequency", "monetary")
    return cuts.select(F.explode(rows).alias("q")).select("q.prob", "q.recency", "q.frequency", "q.monetary")


def rfm_scores(base: DataFrame) -> DataFrame:
    """R 5..1 and F, M 1..5 by quintile; a value on a cut goes with the lower bin."""
    cuts = exact_quantiles(base, ["recency", "frequency", "monetary"], QUINTILES)
    tagged = attach_one_row(base, cuts, "cuts")
    return tagged.select(
        "client_id",
        "recency",
        "frequency",
        "monetary",
        score_descending("cast(recency as double)", "cuts.recency", 4).alias("r_score"),
        score_ascending("cast(frequency as double)", "cuts.frequency", 4).alias("f_score"),
        score_ascending("cast(monetary as double)", "cuts.monetary", 4).alias("m_score"),
    )


def rfm_segments(base: DataFrame) -> DataFrame:
    """Scores with the three-digit text and the named segment."""
    r, f, m = (F.col(c).cast("string") for c in ("r_score", "f_score", "m_score"))
    return rfm_scores(base).withColumn("rfm_score", F.concat(r, f, m)).withColumn("segment", rfm_segment(F.concat(r, f)))


def segment_counts(segments: DataFrame) -> DataFrame:
    """Clients and whole-number percentage share per segment. The table has one row per segment, eleven at most."""
    sized = segments.groupBy("segment").agg(F.count(F.lit(1)).alias("clients"))
    whole = F.sum("clients").over(Window.partitionBy())
    return sized.withColumn("share_percent", F.floor(F.col("clients") * 100 / whole))


def segment_statistics(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean, sum, count, max, min and sample standard deviation of a value by segment."""
    v = F.col(value)
    return df.groupBy(by).agg(
        (F.sum(v).cast("double") / F.count(v)).alias("mean_value"), F.sum(v).alias("sum_value"), F.count(v).alias("clients"),
        F.max(v).alias("max_value"), F.min(v).alias("min_value"), F.stddev_samp(v).alias("std_value"),
    )


def client_txn_summary(txns: DataFrame) -> DataFrame:
    return txns.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("volume"),
        F.sum("amount").alias("value"),
        F.min("amount").alias("smallest"),
        F.max("amount").alias("largest"),
        (F.sum("amount").cast("double") / F.count("amount")).alias("mean_amount"),
    )


def active_dormancy(
    clients: DataFrame, txns_with_balance: DataFrame, as_of: DateLike, months: int = 12
) -> DataFrame:
    """Activity of each open client with a movement in the last ``months``: sticky, status, idle days, age in months,
    first and last movement, volume, value, mean balance. Counts each transaction once."""
    since = years_back(as_of, months)
    moves = (
        txns_with_balance.filter(F.col("type_enum").isin(1, 2) & (F.col("transaction_date") >= F.lit(since)))
        .groupBy("client_id")
        .agg(
            F.min("transaction_date").cast("date").alias("first_transaction_date"),
            F.max("transaction_date").cast("date").alias("last_transaction_date"),
            F.count(F.lit(1)).alias("transaction_volume"),
            F.sum("amount").alias("total_transaction_value"),
            F.sum("running_balance").alias("balance_sum"),
        )
    )
    open_clients = clients.filter(F.lower("client_status") != "closed").select("client_id", "activation_date")
    idle = F.datediff(day(as_of), "last_transaction_date")
    return moves.join(open_clients, "client_id").select(
        "client_id",
        bands.stickiness(idle).alias("sticky"),
        bands.activity_status(idle).alias("account_status"),
        idle.alias("days_since_last_transaction"),
        month_boundaries(F.col("activation_date"), day(as_of)).alias("age_banked_in_months"),
        "first_transaction_date",
        "last_transaction_date",
        "transaction_volume",
        "total_transaction_value",
        (F.col("balance_sum").cast("double") / F.col("transaction_volume")).alias("avg_bal"),
    )


def client_demographics(clients: DataFrame, identity: DataFrame, states: DataFrame, as_of: DateLike) -> DataFrame:
    """Open clients with identity data, state name and generation; first activation date per distinct profile."""
    keys = ["client_id", "client_name", "mobile_number", "state", "gender", "dob_text", "generation", "client_tier",
            "client_category"]
    joined = (
        clients.filter(F.lower("client_status") != "closed")
        .join(identity, "client_id", "left")
        .join(states, "state_id", "left")
        .withColumn("generation", bands.generation_cohort(F.col("dob_text")))
    )
    return joined.groupBy(*keys).agg(F.min("activation_date").alias("date_onboarded")).withColumn("run_date", day(as_of))


def generation_counts(clients: DataFrame) -> DataFrame:
    return (
        clients.filter(F.lower("client_status") != "closed")
        .groupBy(bands.generation_cohort(F.col("dob_text")).alias("generation"))
        .agg(F.count(F.lit(1)).alias("clients"))
    )


def adoption_matrix(
    clients: DataFrame, evidence: Mapping[str, tuple[DataFrame, Column | None]], as_of: DateLike
) -> DataFrame:
    """One row per client with a '0'/'1' text flag per entry of ``evidence``.

    ``evidence`` maps a flag to the table that proves it and a condition. Tables used for several flags are read once:
    each table gives one bit per flag and client with a map-side ``max``, then all tables are united and combined by
    client in one shuffle. No join per flag.
    """
    sources: dict[int, tuple[DataFrame, dict[str, Column]]] = {}
    for flag, (table, condition) in evidence.items():
        entry = sources.setdefault(id(table), (table, {}))
        entry[1][flag] = F.lit(True) if condition is None else condition
    parts = []
    for table, conditions in sources.values():
        bits = [
            F.when(conditions[flag], 1).otherwise(0).alias(flag) if flag in conditions else F.lit(0).alias(flag)
            for flag in evidence
        ]
        parts.append(table.select("client_id", *bits).filter(F.greatest(*[F.col(f) for f in evidence]) == 1))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    proven = united.groupBy("client_id").agg(*[F.max(f).alias(f) for f in evidence])
    flags = [F.coalesce(F.col(f), F.lit(0)).cast("string").alias(f) for f in evidence]
    return clients.select("client_id", "client_category").join(proven, "client_id", "left").select(
        "client_id", "client_category", *flags, F.lit(as_date(as_of)).alias("run_date")
    )
