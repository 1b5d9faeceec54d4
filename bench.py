"""Benchmark of the headline jobs.

usage: BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: total seconds of the headline queries plus per-query
seconds. Each query is run to completion with the ``noop`` sink (the full
plan executes, nothing is collected). ``prepare_splits`` is the one-time
write of the cleaned table (partitioned by year) that the later jobs read.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lendscope.plans import pipeline  # noqa: E402
from lendscope.plans.registry import QUERIES  # noqa: E402
from lendscope.session import get_session  # noqa: E402

HEADLINE = ["drift_report", "drift_summary", "stratified_cap", "split_report", "roc_auc",
            "classification_report", "one_hot_long", "transform_splits",
            "lr_coefficients", "score_batch", "drift_stream", "rf_v1_importance"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    times = {}
    t0 = time.time()
    pipeline.stored_path(spark, sf_dir)
    times["prepare_splits"] = round(time.time() - t0, 3)
    errors = {}
    for name in names:
        t = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t, 3)
        except Exception as e:  # noqa: BLE001 -- report, keep the one-line contract
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
