"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from leadspark.plans.catalog import QUERIES  # noqa: E402
from leadspark.session import local_session  # noqa: E402

HEADLINE = [
    "cte_chain",
    "src_modeling",
    "enc_features",
    "scr_leads",
    "agg_gains",
    "met_ap",
    "met_auc",
    "win_rank_avg",
    "smp_stratified",
    "enc_target_cv",
    "enc_onehot_rare",
    "srt_cube",
    "join_lookup_pivot",
    "agg_describe",
    "agg_topcat",
    "lk_knn",
    "mdl_two_stage",
    "mdl_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the JVM's workers
    times = {}
    for name in names:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
