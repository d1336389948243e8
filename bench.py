"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, or ``all``) choose what runs where.
Each query is run to the end without keeping its rows, BENCH_RUNS times (default 3), and
its median counts; the first run of a session warms the JVM up on another query.

The given tables are single files of one row group, which one task has to read. So they
are first copied, untimed, into as many files as there are cores, as a cluster would have
them.
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import sys
import tempfile
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from railpulse.checks.queries import QUERIES  # noqa: E402
from railpulse.session import local_session  # noqa: E402

HEADLINE = (
    "scheduled_headway",
    "scheduled_travel_time",
    "gtfs_metrics",
    "scheduled_metric_means",
    "direction_lookup_secondary",
    "direction_id",
    "scheduled_metrics",
    "snapshot_read",
    "event_generation",
    "collate_range",
    "collation_summary",
    "event_dedupe",
    "raw_events_valid",
    "explode_stations",
    "daily_store",
)
TABLES = ("customer", "events", "lineitem", "orders")


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def copied(spark, sf_dir: str, files: int) -> str:
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(
            f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    cores, runs = int(os.environ.get("BENCH_CPUS", "8")), int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores)
    tables = copied(spark, sf_dir, cores)
    run(spark, "event_counts", tables)
    seconds = {name: round(statistics.median(run(spark, name, tables) for _ in range(runs)), 3)
               for name in names}
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": pathlib.Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
