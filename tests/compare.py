"""Runs queries in Spark and their oracle in DuckDB and compares values.

    python tests/compare.py [--sf 0.01] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
DATA = "/root/testdata/sf{}"


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "\0null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v) if v != int(v) else repr(float(v))
    return f"{type(v).__name__}:{v}"


def rows(names: list[str], data: list) -> tuple[list[str], list]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in data)


def compare(spark, con, sf_dir: str, fn, sql: str) -> str:
    """Empty when equal, else what differs."""
    df = fn(spark, sf_dir)
    left = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right = rows([c[0] for c in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] != right[1]:
        only_left = sorted(set(left[1]) - set(right[1]))[:3]
        only_right = sorted(set(right[1]) - set(left[1]))[:3]
        return (f"rows {len(left[1])} vs {len(right[1])}\n   cols {left[0]}\n   spark only {only_left}\n"
                f"   oracle only {only_right}")
    return "" if left[1] else "empty result"


def main(argv: list[str]) -> int:
    from eventloom import catalog
    from eventloom.session import local_session

    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    queries, oracles = catalog.queries(), catalog.oracles()
    spark, sf_dir, bad = local_session(), DATA.format(sf), 0
    con = duck(sf_dir)
    for key in argv or list(queries):
        start = time.time()
        try:
            if key in oracles:
                problem = compare(spark, con, sf_dir, queries[key], oracles[key])
            else:
                problem = "" if queries[key](spark, sf_dir).count() else "empty result"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - start:.1f}s "
              f"{'' if key in oracles else '(no oracle) '}{problem}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
