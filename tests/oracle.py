"""Run registered queries beside their SQL twins. ``python -m tests.oracle [sf] [name ...]``"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

DATA = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        f = float(v)
        return 0.0 if f == 0 else f
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return str(v)


def normal(cols: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def same(a, b) -> str | None:
    """None where both results agree, else what differs."""
    (ca, ra), (cb, rb) = a, b
    if ca != cb:
        return f"columns {ca} vs {cb}"
    if len(ra) != len(rb):
        return f"rows {len(ra)} vs {len(rb)}"
    for x, y in zip(ra, rb):
        if x != y:
            return f"{x} vs {y} (of {sum(p != q for p, q in zip(ra, rb))} differing rows)"
    return None


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[str | None, float, int]:
    from leadspark.plans.catalog import ORACLES, QUERIES

    t = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    took = time.time() - t
    if name not in ORACLES:
        return None, took, len(rows)
    con = con or duck(sf_dir)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    return same(normal(df.columns, rows), normal(cols, cur.fetchall())), took, len(rows)


def main(argv: list[str]) -> int:
    from leadspark.plans.catalog import ORACLES, QUERIES
    from leadspark.session import local_session

    sf = "sf0.01"
    if argv and argv[0].startswith("sf"):
        sf, argv = argv[0], argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(f"{DATA}/{sf}")
    names = [n for n in QUERIES if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    bad = 0
    for n in names:
        try:
            diff, took, rows = compare(spark, n, f"{DATA}/{sf}", con)
        except Exception as e:  # report and go on with the next query
            diff, took, rows = f"{type(e).__name__}: {str(e)[:600]}", 0.0, -1
        kind = "sql " if n in ORACLES else "rows"
        print(f"{'ok ' if diff is None else 'BAD'} {kind} {n:28s} {took:6.2f}s rows={rows} {diff or ''}", flush=True)
        bad += diff is not None
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
