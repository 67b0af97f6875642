"""Compare registered queries with their SQL in DuckDB: ``check.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kelpfit.plans import load  # noqa: E402
from kelpfit.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v) + 0.0
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r)))


def compare(spark, con, name: str, folder: str) -> str | None:
    """Problem found, or None when columns and every value agree exactly."""
    queries, oracles = load()
    df = queries[name](spark, folder)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return None if got[1] else "no rows"
    result = con.execute(oracles[name])
    want = table([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(want[1])} rows differ, first {bad[0]}"
    return None if want[1] else "no rows"


def main(names: list[str]) -> int:
    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(8), connect(folder)
    queries, oracles = load()
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as e:  # report and go on with the others
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        mark = "FAIL" if problem else "ok  " if name in oracles else "rows"
        print(f"{mark} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
