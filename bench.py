"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` write (the whole plan runs, nothing is
collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "job_top_customers", "agg_group_multi", "agg_revenue", "agg_count_distinct", "agg_cube", "agg_pivot",
    "agg_collect", "kv_join3", "join_full3", "job_station_counts", "wc_clean", "txt_stats", "win_combined",
    "win_running_net", "win_top1_per_group", "prj_rowid", "ord_agg_topn", "set_intersect", "sql_join3",
    "doc_unwind_sum", "job_sales_units_city", "str_tumbling", "str_join_windows", "str_loyalty",
    "win_combined_split",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE

    from corvid.plans.registry import all_queries
    from corvid.session import build_session, scratch_scope

    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    queries = all_queries()

    def run(name: str) -> float:
        with scratch_scope(spark):
            t0 = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

    # warm-up pass (class loading, JIT, codegen caches), then the timed pass
    for name in names:
        run(name)
    timings = {}
    for name in names:
        timings[name] = round(run(name), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
