"""Time headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.all import QUERIES  # noqa: E402
from haulmark.operators import skew  # noqa: E402
from haulmark.session import spark_session  # noqa: E402

HEADLINE = [
    "o_4_01_distinct_on_first", "o_4_06_collapse_runs", "o_5_10_interval_latest", "o_5_11_neighbours", "o_6_04_conditional_distinct",
    "o_6_05_milestones", "o_7_01_attempt_rank", "o_10_15_attempt_timeline", "o_10_21_first_attempt_success", "o_10_22_productivity",
    "o_10_25_scorecard_running", "o_10_28_minimum_guarantee", "o_10_32_allocate_to_orders", "o_10_39_margin_by_client", "o_10_42_pnl_daily",
    "o_11_01_incremental_recompute", "o_12_01_upsert", "o_13_01_duplicates", "p_01_tracking_events", "p_05_outflow_table", "p_09_main_metric_table",
    "p_16_vendor_margins", "p_17_rider_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    wanted = sys.argv[1:] or HEADLINE
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = spark_session("bench", f"local[{cpus}]", shuffle_partitions=max(4, cores), extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="haulmark-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("o_6_01_basic_aggregates", "o_7_01_attempt_rank", "o_10_21_first_attempt_success"):  # warm-up
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        runs = []
        for _ in range(repeat):
            skew.forget(spark)  # every run counts its hot keys itself
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
        print(name, times[name], file=sys.stderr)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
