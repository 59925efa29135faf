"""Incremental loads, repairs and batch cuts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.dates import DateLike, on_day


def incremental_since(source: DataFrame, target: DataFrame, key: str, limit: int | None = None, default: int = 0) -> DataFrame:
    """Source rows above the highest key of the target.

    The high-water mark is a scalar subquery: computed once, then a constant in the filter on the scan. ``limit`` takes
    the lowest ``limit`` new keys, as a pull of bounded size does.
    """
    mark = target.agg(F.coalesce(F.max(key), F.lit(default))).scalar()
    fresh = source.filter(F.col(key) > mark)
    return fresh if limit is None else fresh.orderBy(key).limit(limit)


def incremental_since_both(
    source: DataFrame, target: DataFrame, key: str, ts: str, default_key: int = 0, default_ts: str = "2000-01-01"
) -> DataFrame:
    """Rows above both the id mark and the time mark; an empty target gives the defaults."""
    start = F.lit(default_ts).cast("timestamp_ntz")
    id_mark = target.agg(F.coalesce(F.max(key), F.lit(default_key))).scalar()
    ts_mark = target.agg(F.coalesce(F.max(ts), start)).scalar()
    return source.filter((F.col(key) > id_mark) & (F.col(ts) > ts_mark))


def incremental_since_slower(source: DataFrame, targets: Sequence[DataFrame], key: str, default: int = 0) -> DataFrame:
    """Rows above the lowest of the targets' marks: resumes where the slower target stopped."""
    marks = [t.agg(F.coalesce(F.max(key), F.lit(default))).scalar() for t in targets]
    return source.filter(F.col(key) > F.least(*marks))


def missing_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is not in the target."""
    return source.join(target.select(key), key, "left_anti")


#: Differing ranges that a filter names; beyond that all keys are compared.
NAMED_RANGES = 500


def range_checks(df: DataFrame, key: str, width: int) -> DataFrame:
    """Per range of ``width`` integer keys: rows and a checksum of the keys that their order does not change."""
    digest = F.xxhash64(F.col(key).cast("long"))
    return df.filter(F.col(key).isNotNull()).groupBy(F.floor(F.col(key) / width).alias("key_range")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(digest).alias("xor"), F.sum(digest.cast("decimal(20,0)")).alias("total")
    )


def differing_ranges(source: DataFrame, target: DataFrame, key: str, width: int) -> DataFrame:
    """Ranges of keys whose rows or checksums differ between two tables. One row per range is shuffled."""
    sides = range_checks(source, key, width).withColumn("side", F.lit(1)).unionByName(
        range_checks(target, key, width).withColumn("side", F.lit(-1))
    )
    signed = lambda c: F.sum(F.col(c) * F.col("side"))
    net = sides.groupBy("key_range").agg(signed("rows").alias("rows"), F.bit_xor("xor").alias("xor"), signed("total").alias("total"))
    return net.filter((F.col("rows") != 0) | (F.col("xor") != 0) | (F.col("total") != 0)).select("key_range")


def _of_ranges(df: DataFrame, key: str, width: int, ranges: list[int]) -> DataFrame:
    spans: list[list[int]] = []
    for r in ranges:  # neighbours are one span
        if spans and spans[-1][1] == r:
            spans[-1][1] = r + 1
        else:
            spans.append([r, r + 1])
    within = [(F.col(key) >= a * width) & (F.col(key) < b * width) for a, b in spans]
    return df.filter(reduce(or_, within, F.lit(False)))


def _key_bits(df: DataFrame, key: str, side: str) -> DataFrame:
    """One row per 64 neighbouring keys: bit k of ``side`` is set where the key 64 * word + k is there."""
    return df.select(F.col(key).cast("long").alias("key")).select(
        F.shiftright("key", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.expr("cast(key & 63 as int)")).alias("bit")
    ).groupBy("word").agg(F.bit_or("bit").alias(side))


def reconcile(source: DataFrame, target: DataFrame, key: str, width: int = 1 << 16) -> DataFrame:
    """Keys that only one of two large tables has: ``side`` is 'missing' (from the target) or 'surplus' (in it).

    Both tables are compared range by range on counts and checksums, which shuffles a row per range. Up to ``NAMED_RANGES``
    ranges that differ are named in a filter that reaches the scan, so a table that lies in order of its key skips the rest;
    with more of them all keys are compared. Keys are compared as bits, 64 neighbours a row, which each task unites before
    they are shuffled; no task sorts or holds the rows of the tables. Rows without a key and repeats of a key do not show.
    Equal tables give no rows. ``key`` is an integer.
    """
    differing = differing_ranges(source, target, key, width)
    found = [r["key_range"] for r in differing.limit(NAMED_RANGES + 1).collect()]
    ours, theirs = (df.select(key).filter(F.col(key).isNotNull()) for df in (source, target))
    if len(found) <= NAMED_RANGES:
        ours, theirs = (_of_ranges(df, key, width, sorted(found)) for df in (ours, theirs))
    kind = ours.unionByName(theirs).schema[key].dataType
    sides = _key_bits(ours, key, "ours").unionByName(_key_bits(theirs, key, "theirs"), allowMissingColumns=True)
    words = sides.groupBy("word").agg(*[F.coalesce(F.bit_or(c), F.lit(0).cast("long")).alias(c) for c in ("ours", "theirs")])
    apart = words.withColumn("only", F.col("ours").bitwiseXOR(F.col("theirs"))).filter("only <> 0")
    place = F.explode(F.expr("filter(sequence(0, 63), k -> shiftright(only, k) & 1 = 1)"))
    return apart.select("word", "ours", place.alias("place")).select(
        (F.col("word") * 64 + F.col("place")).cast(kind).alias(key),
        F.when(F.expr("shiftright(ours, place) & 1 = 1"), "missing").otherwise("surplus").alias("side"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def exact_row_repair(df: DataFrame) -> DataFrame:
    """The table with exact repeats of a row removed."""
    return df.dropDuplicates()


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in a stated order. The rank limit is applied in each task before the shuffle."""
    pick = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(pick)).filter(F.col("_n") == 1).drop("_n")


def id_ranges(df: DataFrame, key: str, start: int, step: int) -> DataFrame:
    """Adds the batch number of the id range a row falls in, for ids from ``start``."""
    return df.filter(F.col(key) >= start).withColumn("batch", F.floor((F.col(key) - start) / step))


def time_slices(df: DataFrame, ts: str, minutes: int, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Measures by tumbling time slice: all slices of all days in one job."""
    return (
        df.groupBy(F.window(ts, f"{minutes} minutes").alias("w"), *keys)
        .agg(*measures)
        .select(F.col("w.start").alias("slice_start"), F.col("w.end").alias("slice_end"), "*")
        .drop("w")
    )


def slices_of_day(df: DataFrame, ts: str, the_day: DateLike, minutes: int, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    return time_slices(df.filter(on_day(F.col(ts), the_day)), ts, minutes, keys, measures)


def normalize_columns(df: DataFrame, renames: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """Lower-case names, renamed and put in order."""
    lowered = df.toDF(*[c.strip().lower() for c in df.columns])
    return lowered.withColumnsRenamed(dict(renames)).select(*order)


def stage_tables(
    names: Sequence[str], read: Callable[[str], DataFrame], write: Callable[[DataFrame, str], None],
    since: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> None:
    """Loads tables by name: those in ``since`` (target, key) incrementally, the others in full."""
    for name in names:
        source = read(name)
        if since and name in since:
            target, key = since[name]
            source = incremental_since(source, target, key)
        write(source, name)
