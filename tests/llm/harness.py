"""Run queries of the subpackage beside their SQL twins: ``python -m tests.llm.harness [sf] [name ...]``"""

from __future__ import annotations

import sys
import time

from leadspark.llm.catalog import ORACLES, QUERIES
from leadspark.session import local_session
from tests.oracle import DATA, duck, normal, same


def compare(spark, name, sf_dir, con=None):
    rows = (df := QUERIES[name](spark, sf_dir)).collect()
    if name not in ORACLES:
        return None, len(rows)
    cur = (con or duck(sf_dir)).execute(ORACLES[name])
    return same(normal(df.columns, rows), normal([d[0] for d in cur.description], cur.fetchall())), len(rows)


if __name__ == "__main__":
    sf = sys.argv[1]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    for n in sys.argv[2:] or QUERIES:
        t = time.time()
        print(n, *compare(spark, n, f"{DATA}/{sf}"), f"{time.time() - t:.1f}s", "sql" if n in ORACLES else "rows", flush=True)
