"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of the tables, BENCH_CPUS: local cores. Every query runs
once to warm up and is then timed once, with planning and all probe jobs, down
to the last row (noop sink).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tracewright.catalog import queries  # noqa: E402

HEADLINES = (
    "event_log", "xes_traces", "ts_parse_pipeline", "multi_event_rows", "single_event_rows",
    "case_metrics", "field_semantics", "actor_behavior", "stage_violations",
    "transition_counts", "temporal_shares", "single_event_summary", "column_profile",
    "value_frequencies", "bucket_suggestions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, seconds = queries(), {}
    for timed in (False, True):
        for name in HEADLINES:
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
