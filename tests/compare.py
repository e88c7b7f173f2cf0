"""Run registered queries in Spark and DuckDB and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime) or not isinstance(v, datetime.date):
        return v
    return v.isoformat()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(got)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(names)}\n   spark {x}\n   duck  {y}", len(got)
    return None, len(got)


if __name__ == "__main__":
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from tests.conftest import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session()
    con = duck(sf)
    sqls = e.oracle_sql()
    bad = 0
    for name, q in e.queries().items():
        if name not in sqls or only and name not in only:
            continue
        t = time.time()
        try:
            msg, n = compare(spark, con, q, sqls[name], sf)
        except Exception as ex:  # noqa: BLE001
            msg, n = f"{type(ex).__name__}: {str(ex)[:600]}", -1
        bad += msg is not None
        print(f"{'ok ' if msg is None else 'BAD'} {name} rows={n} {time.time() - t:.2f}s {msg or ''}", flush=True)
    print("bad", bad)
