"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]``: a warm-up pass over all of
them, then per query the median of ``$BENCH_REPS`` (default 3) timed runs. A run executes the whole
plan into Spark's no-op sink (nothing is collected to the driver). Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitpanel import get_spark  # noqa: E402
from pitpanel.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "fundamentals_merged", "keep_recent", "lag_features", "panel_a", "panel_b",
    "panel_c_merged", "panel_after", "items_wide_chain", "items_wide_pivot",
    "predictor_acc", "price_match", "match_latest", "attach_item", "lenient_cast",
    "profile_nulls",
]


def run(spark, name, sf):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="pitpanel-bench", shuffle_partitions=int(cpus) * 2,
                      conf={"spark.driver.memory": "16g"})
    for name in names:                      # warm-up pass: JIT, file listing caches
        run(spark, name, sf)
    out = {}
    for name in names:
        out[name] = round(statistics.median(run(spark, name, sf) for _ in range(reps)), 3)
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf_label, "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
