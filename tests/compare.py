"""Run registered queries next to their SQL in DuckDB and compare whole results.

Usage: python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return (type(v).__name__, f"{v:.9g}" if isinstance(v, float) else str(v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, folder: str, name: str, query, sql: str | None) -> tuple[bool, str]:
    began = time.time()
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - began
    if sql is None:
        return len(rows) > 0, f"{len(rows)} rows, {took:.1f}s (no SQL)"
    began = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    sql_took = time.time() - began
    a, b = normal(df.columns, rows), normal(names, theirs)
    note = f"{len(rows)} rows, spark {took:.1f}s, duckdb {sql_took:.1f}s"
    if a == b:
        return len(rows) > 0, note
    if a[0] != b[0]:
        return False, f"{note}; columns {a[0]} against {b[0]}"
    wrong = [(x, y) for x, y in zip(a[1], b[1]) if x != y][:2]
    return False, f"{note}; {len(theirs)} rows expected; first differences {str(wrong)[:900]}"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from wardstar.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name in argv[1:] or queries:
        try:
            good, note = compare(spark, con, folder, name, queries[name], sql.get(name))
        except Exception as error:  # report and go on with the other queries
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if good else 'FAIL'} {name}: {note}", flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
