"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and then a few times; the median counts. The
result is written to Spark's no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.catalog import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "clean_orders",
    "revenue_by_region",
    "top_n_per_group",
    "running_total",
    "sessionize",
    "join_point_in_time",
    "scd2_merge",
    "merge_upsert",
    "apply_cdc_log",
    "dq_suite",
    "word_count",
    "golden_record",
    "stream_tumbling",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    settings = {"spark_ui_enabled": "false", "spark_driver_memory": "12g", "spark_ui_showConsoleProgress": "false"}
    spark = build_session("millrace-bench", f"local[{cpus}]", **settings)
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
