"""Runs registered queries in Spark and their SQL in DuckDB and compares rows. Also a script: parity.py [sf_dir] [names]."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, decimal.Decimal):
        return (9, f"decimal {value}")
    if isinstance(value, (dt.date, dt.datetime)):
        return (9, f"date {value}")
    if isinstance(value, float):
        return (2, repr(round(value, 6) + 0.0))
    if isinstance(value, int):
        return (3, str(value))
    return (4, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None where both sides agree, else what differs."""
    spark_names, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_names, duck_rows = rows_of([d[0] for d in result.description], result.fetchall())
    if spark_names != duck_names:
        return f"columns {spark_names} against {duck_names}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows against {len(duck_rows)}"
    for left, right in zip(spark_rows, duck_rows):
        if left != right:
            bad = [(n, a, b) for n, a, b in zip(spark_names, left, right) if a != b]
            return f"values {bad[:4]} in {left[:6]}"
    return None


def main() -> None:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from coffer.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    wanted = sys.argv[2:]
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracle:
                fault = compare(df, con, oracle[name])
            else:
                fault = None if df.count() else "no rows"
            n = None if fault else df.count() if "-v" in wanted else ""
        except Exception as exc:  # the report goes on with the next query
            fault = f"{type(exc).__name__}: {str(exc)[:600]}"
            n = ""
        bad += fault is not None
        print(f"{'ok ' if fault is None else 'BAD'} {time.time() - start:6.2f}s {name} {fault or n}", flush=True)
    missing = set(oracle) - set(entry.queries())
    print(f"{bad} bad; oracle without query: {sorted(missing)}")


if __name__ == "__main__":
    main()
