"""Compare every registered query with its SQL.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value) if not isinstance(value, str) else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("\0" if r[i] is None else canon(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, key, fn, sql):
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}", len(got)
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"rows differ: {len(got)} / {len(want)}\n   got  {extra}\n   want {missing}", len(got)
    return None, len(got)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tributary.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles, bad = oracle_sql(), 0
    for key, fn in queries().items():
        if wanted and key not in wanted:
            continue
        t0 = time.time()
        try:
            if key in oracles:
                problem, n = compare(spark, con, sf_dir, key, fn, oracles[key])
            else:
                problem, n = None, fn(spark, sf_dir).count()
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        note = "" if key in oracles else " (no SQL)"
        print(f"{'FAIL' if problem else 'ok  '} {key:28s} {n:8d} rows {time.time() - t0:6.2f}s{note}"
              + (f"\n   {problem}" if problem else ""), flush=True)
    print("missing SQL:", sorted(set(queries()) - set(oracles)))
    print("SQL without query:", sorted(set(oracles) - set(queries())))
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
