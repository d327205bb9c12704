"""Seconds per headline query, printed as one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of threads.  Every
query runs to its last row into a sink that drops them; a query runs once
before it is timed if BENCH_WARM is 1 (the default).
"""

from __future__ import annotations

import json
import os
import sys
import time

from metascope.session import build_session
from metascope.suite import QUERIES

HEADLINES = (
    "src1_objects_all_options",
    "flt_large_objects_of_a_bucket",
    "src6_query_errors",
    "jn1_jobs_with_last_run",
    "jn1_failed_jobs",
    "jn2_training_details",
    "jn3_tag_rows",
    "jn7_counts_by_prefix",
    "agg1_total_size",
    "agg3_by_type_and_status",
    "agg7_failures_per_machine",
    "agg8_run_summary",
    "agg10_tag_maps",
    "srt1_newest_first",
    "lim2_top",
    "set3_cost_report",
    "sc1_size_text",
    "sc11_json_text",
    "act1_retry_plan",
    "act7_object_rules",
    "snk1_table",
    "str2_stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "metascope-bench",
        f"local[{cpus}]",
        {
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        if os.environ.get("BENCH_WARM", "1") == "1":
            run(name)
        seconds[name] = round(run(name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
