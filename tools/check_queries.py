"""Compare registered queries with their SQL in DuckDB.

    python tools/check_queries.py [--sf 0.001] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from capsieve import catalog  # noqa: E402
from capsieve.plans.standins import BASE_TABLES  # noqa: E402


def normal(value):
    """Comparable form of a result value."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, folder):
    """``(ok, message)`` for one query."""
    started = time.time()
    df = fn(spark, folder)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if sql is None:
        return True, f"{sum(got.values())} rows (no SQL) {took:.1f}s"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    wanted_columns, wanted = rows_of(names, result.fetchall())
    if columns != wanted_columns:
        return False, f"columns {columns} != {wanted_columns}"
    if got != wanted:
        extra, missing = list((got - wanted).items()), list((wanted - got).items())
        return False, (f"{sum(got.values())} rows vs {sum(wanted.values())}; {len(extra)} extra, {len(missing)} missing"
                       f"\n   got    {sorted(extra, key=str)[:3]}\n   wanted {sorted(missing, key=str)[:3]}")
    return True, f"{sum(got.values())} rows {took:.1f}s"


def connect(folder):
    import duckdb
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.001")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from capsieve.session import local_session
    spark = local_session()
    folder = f"/root/testdata/sf{args.sf}"
    con = connect(folder)
    queries, sql = catalog.queries(), catalog.oracle_sql()
    failed = []
    for name in args.names or queries:
        try:
            ok, message = compare(spark, con, name, queries[name], sql.get(name), folder)
        except Exception as error:  # report and go on with the next query
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
