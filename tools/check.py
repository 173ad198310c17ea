"""Run registered queries against their SQL on the same tables and compare values.

    python tools/check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import pathlib
import sys
import time

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def plain(x):
    """A value in a form both engines share; the type still shows."""
    if isinstance(x, float):
        return ("float", repr(x))
    if isinstance(x, bool):
        return ("bool", repr(x))
    if isinstance(x, int):
        return ("int", repr(x))
    if isinstance(x, (dt.date, dt.datetime)):
        return ("date", x.isoformat())
    return (type(x).__name__, str(x))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def compare(spark, con, sf, reg) -> tuple[str, int, float]:
    start = time.time()
    df = reg.plan(spark, sf)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if reg.sql is None:
        return "rows only", len(got), took
    cur = con.execute(reg.sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"COLUMNS {sorted(df.columns)} != {sorted(want_cols)}", len(got), took
    a, b = rows_of(df.columns, got), rows_of(want_cols, want)
    if len(a) != len(b):
        return f"ROWS {len(a)} != {len(b)}", len(got), took
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        names = sorted(df.columns)
        diff = [(n, p, q) for n, p, q in zip(names, *bad[0]) if p != q]
        return f"VALUES {len(bad)} differ, first {diff}", len(got), took
    return "ok" if got else "EMPTY", len(got), took


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true", help="a session with no settings of ours")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from seriesforge import session
    from seriesforge.plans.catalog import load_all

    if args.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        spark = session.build(
            master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
        )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = 0
    for name, reg in load_all().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        try:
            result, n, took = compare(spark, con, args.sf, reg)
        except Exception as exc:  # noqa: BLE001
            result, n, took = f"ERROR {type(exc).__name__}: {str(exc)[:600]}", 0, 0.0
        if result not in ("ok", "rows only"):
            failed += 1
            print(f"{name:36s} {n:8d} {took:6.2f}s  {result}", flush=True)
        else:
            print(f"{name:36s} {n:8d} {took:6.2f}s  {result}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
