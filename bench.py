"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads, BENCH_RUNS the timed runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tributary.queries.registry import QUERIES  # noqa: E402
from tributary.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "map_charges", "map_invoices", "validate_charges", "dedupe_newest", "transform_invoices", "transform_all",
    "transform_summary", "raw_landing_roundtrip", "processed_zone_roundtrip", "upsert_merge", "max_event_time",
    "end_to_end",
)


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, name)
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
