"""Run registered queries beside their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tableloom.workloads.registry import TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    """One form per value, whichever engine it came from."""
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, int):
        return value
    return str(value)


def rows(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def difference(spark, con, fn, sql: str | None, folder: str) -> tuple[str, int]:
    """Empty text when equal, else what differs; and the number of rows."""
    df = fn(spark, folder)
    got = rows(df.columns, df.collect())
    if sql is None:
        return "", len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(got)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else ""), len(got)


def main(names: list[str], folder: str) -> int:
    from tableloom.session import get_spark
    from tableloom.workloads import all_queries, all_sql

    spark = get_spark(master="local[8]", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tableloom-compare-"), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    queries, sql = all_queries(), all_sql()
    for name in names or queries:
        start = time.time()
        try:
            problem, n = difference(spark, con, queries[name], sql.get(name), folder)
        except Exception as err:  # noqa: BLE001
            problem, n = f"{type(err).__name__}: {str(err)[:600]}", -1
        failed += bool(problem)
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind:4} {name:32} {n:7} rows {time.time() - start:6.1f}s {problem}", flush=True)
    print(f"{failed} failed", flush=True)
    return failed


if __name__ == "__main__":
    target = next((a for a in sys.argv[1:] if a.startswith("/")), "/root/testdata/sf0.01")
    sys.exit(main([a for a in sys.argv[1:] if not a.startswith("/")], target))
