"""Compare named queries with their SQL: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value: object) -> object:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return float(value) if isinstance(value, (int, float)) else str(value)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(str, r))
    )


def both(df, con, sql: str):
    """The rows of a frame and of its SQL, in comparable form."""
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    return ours, theirs


def main() -> int:
    import __spark_entry__ as entry
    from clickloom.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if (args and name not in args) or name not in sqls:
            continue
        began = time.time()
        try:
            ours, theirs = both(query(spark, sf_dir), con, sqls[name])
            same = ours == theirs
            print(f"{'ok  ' if same else 'DIFF'} {name}: {len(ours[1])} rows, {time.time() - began:.1f}s", flush=True)
            if not same:
                print("  columns", ours[0], theirs[0], len(theirs[1]))
                print("  ours", [r for r in ours[1] if r not in theirs[1]][:3])
                print("  sql ", [r for r in theirs[1] if r not in ours[1]][:3])
        except Exception as error:  # noqa: BLE001 - a report of all queries is wanted
            same = False
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
        bad += not same
    return bad


if __name__ == "__main__":
    sys.exit(main())
