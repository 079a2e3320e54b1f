"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs once to warm up and then ``BENCH_RUNS`` times (median reported), writing
to the ``noop`` sink so that every row and column is produced. Planning and any
intermediate tables an operator writes are part of the time.
"""

from __future__ import annotations

import json
import os
import statistics
import shutil
import sys
import tempfile
import time

from tableloom.session import get_spark
from tableloom.workloads import all_queries

HEADLINE = (
    "sales_analytics", "union_city_metrics", "window_row_number", "window_whole_table", "dedup_latest_event", "join_left",
    "dq_report", "dq_anomaly_iqr", "merge_upsert", "change_feed", "scd2_history", "surrogate_keys", "fact_attach_keys",
    "normalize_text", "profile_approximate", "watermark_value", "er_groups", "er_similar_documents", "components",
    "run_appends_and_quarantines", "replace_where_partitions", "merge_touched_partitions", "join_outer_on_range_alone", "hierarchy_deep",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="tableloom-bench-")
    spark = get_spark(
        "bench", f"local[{cpus}]",
        **{
            "spark.checkpoint.dir": scratch, "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.log.level": "ERROR",
        },
    )
    queries, seconds = all_queries(), {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: warm-up {taken[0]:.2f}s, median {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
