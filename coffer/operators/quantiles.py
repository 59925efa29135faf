"""Exact quantiles of columns of any size, and the bins cut from them.

Spark's ``percentile`` keeps every distinct value of the column in one aggregation buffer, so one task ends up with the
whole column. Here the wanted order statistics are narrowed down instead: values are counted per narrow band of
magnitude, and only the values of the few bands that hold a wanted rank are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A band spans a factor of e**(1/4096), about 0.024 %, of the magnitude. Amounts up to 1e16 fall into at most 151,000
# bands per sign, so the table of band counts is small however many rows are counted; a band of amounts near m holds at
# most m / 41 distinct cent values.
_BANDS_PER_E = 4096


# Steps into which a band that holds a wanted rank is cut again: scores that lie close together may all share a band.
_STEPS = 4096
_NAN_BAND = 2**62


def _magnitude(value: Column) -> Column:
    return F.signum(value) * F.log1p(F.abs(value)) * _BANDS_PER_E


def _band(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit(_NAN_BAND)).otherwise(F.floor(_magnitude(value)))


def _step(value: Column) -> Column:
    """Place of a value between the edges of its band."""
    place = _magnitude(value) - F.floor(_magnitude(value))
    return F.when(F.isnan(value), F.lit(0)).otherwise(F.floor(place * _STEPS))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row: for each column an array of its quantiles at ``probs``, linear between order statistics.

    Nulls are left out. A column without values gives nulls. NaN stands above all numbers, as in Spark's own order.
    """
    values = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v")) for c in columns])
        ).alias("e")
    ).select("e.col", "e.v").filter(F.col("v").isNotNull())
    # The filter on the band is what the join below would add on its side only; stated here, both uses of the counts
    # have one plan and share one shuffle.
    counted = (
        values.groupBy("col", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("band", _band(F.col("v")))
        .filter(F.col("band").isNotNull())
    )

    # Bands, in order, with the ranks that fall into each: at most two per probability and column.
    whole = Window.partitionBy("col")
    upto = F.sum("n").over(whole.orderBy("band").rowsBetween(Window.unboundedPreceding, 0))
    bands = (
        counted.groupBy("col", "band")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", upto)
        .withColumn("size", F.sum("n").over(whole))
    )
    rank = (F.col("size") - 1) * F.col("prob")
    wanted = (
        bands.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("rank", rank)
        .withColumn("k", F.explode(F.array_distinct(F.array(F.floor("rank"), F.ceil("rank")))))
        .filter((F.col("upto") - F.col("n") <= F.col("k")) & (F.col("k") < F.col("upto")))
        .select("col", "band", "prob", (F.col("rank") - F.floor("rank")).alias("share"),
                (F.col("k") - F.col("upto") + F.col("n")).alias("at"))
    )

    # The step of the band in which the rank lies. ``wanted`` has at most two rows per probability and column.
    place = ["col", "band", "prob", "at"]
    along = Window.partitionBy(*place).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    steps = (
        counted.join(F.broadcast(wanted), ["col", "band"])
        .groupBy(*place, "share", _step(F.col("v")).alias("step"))
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(along))
        .filter((F.col("upto") - F.col("n") <= F.col("at")) & (F.col("at") < F.col("upto")))
        .select("col", "band", "prob", "share", "step", (F.col("at") - F.col("upto") + F.col("n")).alias("at"))
    )

    # Values of those steps, in order, once per wanted rank; again at most two rows per probability and column.
    inside = Window.partitionBy(*place, "step").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        counted.withColumn("step", _step(F.col("v")))
        .join(F.broadcast(steps), ["col", "band", "step"])
        .withColumn("upto", F.sum("n").over(inside))
        .filter((F.col("upto") - F.col("n") <= F.col("at")) & (F.col("at") < F.col("upto")))
    )
    aggs, cuts = [], []
    for i, c in enumerate(columns):
        picks = []
        for j, p in enumerate(probs):
            here = f"col = '{c}' and prob = {float(p)!r}D"
            low, high, share = (f"_{kind}_{i}_{j}" for kind in ("low", "high", "share"))
            aggs += [F.expr(f"min(case when {here} then v end) as {low}"), F.expr(f"max(case when {here} then v end) as {high}"),
                     F.expr(f"max(case when {here} then share end) as {share}")]
            picks.append(f"if({share} = 0, {low}, {low} + ({high} - {low}) * {share})")
        cuts.append(f"array({', '.join(picks)}) as `{c}`")
    return found.agg(*aggs).selectExpr(*cuts)


def attach_one_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Adds a one-row frame to every row as a struct: the row is computed once, as a subquery."""
    row = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("row")).scalar()
    return df.withColumn(name, row)


def score_ascending(value: str, cuts: str, count: int) -> Column:
    """1 .. count+1 by right-closed bins: a value on a cut belongs to the bin below it. ``value`` and ``cuts`` are SQL text."""
    arms = " ".join(f"when {value} <= {cuts}[{i}] then {i + 1}" for i in range(count))
    return F.expr(f"case {arms} else {count + 1} end")


def score_descending(value: str, cuts: str, count: int) -> Column:
    """count+1 .. 1, with the same bins."""
    arms = " ".join(f"when {value} <= {cuts}[{i}] then {count + 1 - i}" for i in range(count))
    return F.expr(f"case {arms} else 1 end")


def quantile_bins(df: DataFrame, column: str, labels: Sequence[str], name: str) -> DataFrame:
    """Labels rows by equal-share bins of a column, lowest bin first; bins are right-closed."""
    n = len(labels)
    probs = [i / n for i in range(1, n)]
    cuts = exact_quantiles(df, [column], probs)
    tagged = attach_one_row(df, cuts, "_cuts")
    score = score_ascending(f"cast({column} as double)", f"_cuts.{column}", n - 1)
    label = F.element_at(F.array(*[F.lit(x) for x in labels]), score)
    return tagged.withColumn(name, F.when(F.col(column).isNotNull(), label)).drop("_cuts")
