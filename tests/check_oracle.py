"""Run registered queries and their SQL on one data folder and compare the rows.

Usage: python tests/check_oracle.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        folder = "/*.parquet" if Path(f"{sf_dir}/{name}.parquet").is_dir() else ""
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet{folder}')")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What tells the two results apart; empty when columns and row bags agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    order = sorted(names)
    wanted = Counter(tuple(r[names.index(n)] for n in order) for r in result.fetchall())
    got = Counter(tuple(r[n] for n in order) for r in df.select(*order).collect())
    notes = []
    if got != wanted:
        notes.append(f"{sum(got.values())} rows, expected {sum(wanted.values())}; {order}")
        notes += [f"  only here: {r}" for r in list((got - wanted))[:3]]
        notes += [f"  only in SQL: {r}" for r in list((wanted - got))[:3]]
    if not got:
        notes.append("empty result")
    return notes


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="check-oracle-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if args and name not in args:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            notes = differences(df, con, sql[name]) if name in sql else ["no SQL"]
        except Exception as error:
            notes = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(notes)
        print("FAIL" if notes else "ok  ", name, f"{time.time() - started:.1f}s", *notes, sep=" ")
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
