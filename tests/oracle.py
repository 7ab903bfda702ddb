"""Compares registered queries with their SQL in DuckDB.

Run as ``python tests/oracle.py [sf_dir] [name ...]`` for a report, or use
``differences`` from a test.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, name: str) -> tuple[int, list]:
    """Number of rows, and up to three differing rows of each side (empty = equal)."""
    df = contract.queries()[name](spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return len(got_rows), []
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return len(got_rows), [("columns", df.columns, want_cols)]
    got, want = rows_of(df.columns, got_rows), rows_of(want_cols, want_rows)
    if got == want:
        return len(got), []
    bad = [(g, w) for g, w in zip(got, want) if g != w][:3]
    return len(got), bad or [("rows", len(got), len(want))]


def main() -> None:
    from tunesmith.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            n, bad = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on
            n, bad = -1, [str(error)[:1500]]
        failed += bool(bad)
        mark = "BAD" if bad else ("ok " if name in contract.oracle_sql() else "ok*")
        print(f"{mark} {name} rows={n} {time.time() - start:.2f}s", flush=True)
        for line in bad:
            print("    ", str(line)[:1500], flush=True)
    print(f"{len(names) - failed}/{len(names)} equal")


if __name__ == "__main__":
    main()
