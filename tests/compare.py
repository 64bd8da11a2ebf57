"""Run registered queries next to their SQL counterpart and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else format(v, ".9g")
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return normal(columns, result.fetchall())


def difference(query, sql, spark, con, sf):
    """None when equal, else a short description."""
    columns, rows = spark_rows(query(spark, sf))
    want_columns, want = oracle_rows(con, sql)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if rows != want:
        extra, missing = set(rows) - set(want), set(want) - set(rows)
        return f"{len(rows)} rows, want {len(want)}; extra {sorted(extra, key=repr)[:3]}; missing {sorted(missing, key=repr)[:3]}"
    return None


def main():
    from tests.session import session
    import __spark_entry__ as entry

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:]
    spark, con = session(), connect(sf)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(query, oracles[name], spark, con, sf)
                count = len(oracle_rows(con, oracles[name])[1])
            else:
                count, problem = query(spark, sf).count(), None
        except Exception as e:  # noqa: BLE001
            problem, count = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={count} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
