"""Run named queries on Spark and on DuckDB and compare the rows.

``python tests/oracle.py sf0.01 [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, query, sf):
    """(matches, message, seconds)."""
    t = time.time()
    df = query.run(spark, sf)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sec = time.time() - t
    if query.sql is None:
        return bool(got[1]), f"rows only: {len(got[1])}", sec
    cur = con.execute(query.sql)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}", sec
    if len(got[1]) != len(want[1]):
        extra = [r for r in got[1] if r not in set(want[1])][:2]
        return False, f"rows {len(got[1])} != {len(want[1])}; {extra}", sec
    for a, b in zip(got[1], want[1]):
        if a != b:
            return False, f"{got[0]}\n   spark {a}\n   duck  {b}", sec
    return True, f"{len(got[1])} rows", sec


def main():
    from catalogflow.queries.registry import all_queries
    from catalogflow.session import get_spark

    sf = sys.argv[1] if "/" in sys.argv[1] else f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = get_spark()
    con = connect(sf)
    bad = 0
    for name, q in all_queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) or q.run.__module__.endswith("." + w) for w in wanted):
            continue
        try:
            ok, msg, sec = compare(spark, con, q, sf)
        except Exception as e:  # report and go on with the next query
            ok, msg, sec = False, f"{type(e).__name__}: {str(e)[:700]}", 0.0
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:32s} {sec:6.2f}s {msg}", flush=True)
    print("bad:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
