import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coffer import schemas
from coffer.plans.catalog import Tables
from coffer.sources import incremental, readers, sinks

SF = "/root/testdata/sf0.001"


def _ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_high_water_with_rows_empty_target_and_limit(spark):
    source = spark.range(10)
    assert _ids(incremental.incremental_since(source, spark.range(7), "id")) == [7, 8, 9]
    assert _ids(incremental.incremental_since(source, spark.range(0), "id")) == list(range(1, 10))
    assert _ids(incremental.incremental_since(source, spark.range(3), "id", limit=2)) == [3, 4]


def test_high_water_is_a_subquery_not_a_join(spark):
    df = incremental.incremental_since(spark.range(10), spark.range(3), "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_two_marks_and_defaults(spark):
    schema = "id int, ts timestamp_ntz"
    rows = [(1, dt.datetime(1999, 1, 1)), (2, dt.datetime(2001, 1, 1)), (3, dt.datetime(2002, 1, 1))]
    source = spark.createDataFrame(rows, schema)
    assert _ids(incremental.incremental_since_both(source, spark.createDataFrame([], schema), "id", "ts")) == [2, 3]
    assert _ids(incremental.incremental_since_both(source, spark.createDataFrame(rows[:2], schema), "id", "ts")) == [3]


def test_slower_mark(spark):
    assert _ids(incremental.incremental_since_slower(spark.range(6), [spark.range(5), spark.range(3)], "id")) == [3, 4, 5]


def test_repairs(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(incremental.exact_row_repair(df)) == [(1, "a"), (1, "b"), (2, "c")]
    assert rows(incremental.duplicate_keys(df, ["k"])) == [(1, 3)]
    assert rows(incremental.one_row_per_key(df, ["k"], [F.col("v").desc()])) == [(1, "b"), (2, "c")]
    assert rows(incremental.missing_keys(df, spark.createDataFrame([(1,)], "k int"), "k")) == [(2, "c")]


def test_null_keys_are_missing(spark, rows):
    df = spark.createDataFrame([(None,), (1,)], "k int")
    assert rows(incremental.missing_keys(df, spark.createDataFrame([(1,), (None,)], "k int"), "k")) == [(None,)]


def test_id_ranges_and_slices(spark, rows):
    got = incremental.id_ranges(spark.range(20), "id", 5, 10).groupBy("batch").count()
    assert rows(got) == [(0, 10), (1, 5)]
    at = [dt.datetime(2024, 1, 1, 0, m) for m in (0, 9, 10)]
    df = spark.createDataFrame([(t,) for t in at], "ts timestamp_ntz")
    got = incremental.slices_of_day(df, "ts", "2024-01-01", 10, [], [F.count(F.lit(1)).alias("n")])
    assert sorted(r["n"] for r in got.collect()) == [1, 2]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` A ` int, B int")
    assert incremental.normalize_columns(df, {"a": "first"}, ["b", "first"]).columns == ["b", "first"]


def test_stage_tables(spark, tmp_path):
    tables = {"full": spark.range(3), "part": spark.range(6)}
    incremental.stage_tables(
        list(tables), tables.get, lambda df, name: sinks.append_rows(df, str(tmp_path / name)), {"part": (spark.range(4), "id")}
    )
    assert _ids(spark.read.parquet(str(tmp_path / "full"))) == [0, 1, 2]
    assert _ids(spark.read.parquet(str(tmp_path / "part"))) == [4, 5]


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([("w1", 1, 2000), ("w2", 2, 2001), ("w1", 3, 2001)], "wallet_name string, v int, year int")
    sinks.write_per_party(df, str(tmp_path / "w"), "wallet_name")
    assert sorted(p for p in os.listdir(tmp_path / "w") if "=" in p) == ["wallet_name=w1", "wallet_name=w2"]
    sinks.write_by_year(df, str(tmp_path / "y"))
    sinks.overwrite_snapshot(df, str(tmp_path / "s"))
    sinks.overwrite_snapshot(df.limit(1), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1
    sinks.write_csv(df, str(tmp_path / "c"))
    back = readers.read_csv_list(spark, str(tmp_path / "c"), df.schema)
    assert rows(back) == rows(df)
    sinks.save_table(df, "coffer_saved")
    assert spark.table("coffer_saved").count() == 3
    pruned = spark.read.parquet(str(tmp_path / "y")).filter("year = 2001")
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()


def test_jdbc_options():
    plain = readers.jdbc_options("u", "select 1", "a", "b")
    assert plain["query"] == "select 1" and "dbtable" not in plain
    split = readers.jdbc_options("u", "select * from t", "a", "b", partition_column="id", lower=0, upper=9, partitions=3)
    assert split["dbtable"] == "(select * from t) src" and split["numPartitions"] == "3" and "query" not in split
    with pytest.raises(ValueError):
        readers.jdbc_options("u", "t", "a", "b", partition_column="id")


def test_conform(spark):
    want = T.StructType([T.StructField("a", T.LongType())])
    assert readers.conform(spark.range(1).selectExpr("id as a", "id as b"), want).columns == ["a"]
    with pytest.raises(readers.SchemaMismatch, match="a: int instead of bigint"):
        readers.conform(spark.range(1).selectExpr("cast(id as int) as a"), want)
    with pytest.raises(readers.SchemaMismatch, match="a: missing"):
        readers.conform(spark.range(1), want)


@pytest.mark.parametrize("view,schema", [
    ("client", schemas.CLIENT), ("account", schemas.ACCOUNT), ("transaction", schemas.TRANSACTION), ("api_call", schemas.API_CALL),
    ("loan", schemas.LOAN), ("schedule", schemas.SCHEDULE), ("payment", schemas.PAYMENT), ("term_deposit", schemas.TERM_DEPOSIT),
    ("card", schemas.CARD), ("journal", schemas.JOURNAL),
])
def test_views_keep_the_declared_schemas(spark, view, schema):
    readers.conform(getattr(Tables(spark, SF), view), schema)


def _files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_repair_writes_only_folders_with_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(k, f"v{k}", k % 5, dt.date(2024, 1, 1 + k % 5)) for k in range(50)]
    again = [(k, "second", k % 5, dt.date(2024, 1, 1 + k % 5)) for k in (1, 6, 3)]
    other_day = [(2, "not a repeat", 0, dt.date(2024, 1, 1))]
    df = spark.createDataFrame(rows + again + other_day, "id int, v string, shard int, day date")
    df.write.partitionBy("shard", "day").parquet(path)
    before = _files(path)
    written = sinks.repair_in_place(spark, path, ["shard", "day"], ["id"], [F.col("v").desc()])
    assert sorted(w[0] for w in written) == [1, 3]
    got = sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == sorted((r[0], r[1]) for r in rows + other_day)
    kept = {f: t for f, t in before.items() if "shard=1" not in f and "shard=3" not in f}
    assert kept.items() <= _files(path).items()
    assert sinks.repair_in_place(spark, path, ["shard", "day"], ["id"], [F.col("v")]) == []


@pytest.mark.parametrize("named", [500, 1])
def test_reconciliation_equals_the_anti_joins_and_reads_differing_ranges(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(incremental, "NAMED_RANGES", named)
    ours = [k for k in range(-300, 5000) if k not in (17, 2500)]
    theirs = [k for k in range(-300, 5000) if k not in (-299, 18, 4999)] + [9000]
    paths = []
    for name, keys in (("a", ours), ("b", theirs)):
        paths.append(str(tmp_path / name))
        spark.createDataFrame([(k,) for k in keys] + [(None,)], "id long").repartitionByRange(20, "id").write.parquet(paths[-1])
    a, b = map(spark.read.parquet, paths)
    found = incremental.reconcile(a, b, "id", width=100)
    got = sorted((r["side"], r["id"]) for r in found.collect())
    assert got == [("missing", -299), ("missing", 18), ("missing", 4999), ("surplus", 17), ("surplus", 2500), ("surplus", 9000)]
    assert sorted(r["key_range"] for r in incremental.differing_ranges(a, b, "id", 100).collect()) == [-3, 0, 25, 49, 90]
    if named == 500:
        spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
        found = incremental.reconcile(a, b, "id", width=100)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("GreaterThanOrEqual(id,2500)") >= 2 and "LessThan(id,2600)" in plan  # reaches both scans
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert incremental.reconcile(a, a, "id", 100).count() == 0
    assert incremental.reconcile(a, a.filter("false"), "id", 1000).count() == len(ours)


@pytest.mark.parametrize("kind", ["bigint", "int", "smallint"])
@pytest.mark.parametrize("named", [500, 0])
def test_reconciliation_compares_keys_as_bits_and_sorts_no_rows(spark, monkeypatch, kind, named):
    monkeypatch.setattr(incremental, "NAMED_RANGES", named)
    ends = {"bigint": (-(1 << 40), (1 << 40) - 1), "int": (-(1 << 31), (1 << 31) - 1), "smallint": (-(1 << 15), (1 << 15) - 1)}[kind]
    ours = [-1, 0, 0, 63, 64, 64, -64, -65, 300, ends[0], None]
    theirs = [0, 63, 65, 65, -64, 7, 300, ends[1], None, None]
    a, b = (spark.createDataFrame([(k,) for k in keys], f"id {kind}") for keys in (ours, theirs))
    found = incremental.reconcile(a, b, "id", width=512)
    assert found.dtypes == [("id", kind), ("side", "string")]
    want = [(k, "missing") for k in (ends[0], -65, -1, 64)] + [(k, "surplus") for k in (7, 65, ends[1])]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort " not in plan
