"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the cores,
BENCH_RUNS (default 3) how often each query runs; the best warm time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from citystream.plans.queries import QUERIES
from citystream.session import build
from citystream.plans import city

HEADLINE = [
    "ward_energy", "ward_energy_lake", "ward_report_daily", "low_power_factor", "rolling_aqi",
    "health_advisories", "health_advisories_sql", "dlq_all", "dlq_report", "valid_bus_gps",
    "route_enriched", "route_enriched_latest", "latest_bus_position", "aqi_emergency", "gridlock", "gridlock_runs_stored",
    "bus_pair_distance", "bus_bunching", "incidents", "signal_feed_high", "decode_event_time", "retained_bus_gps",
    "ward_energy_stream_update", "ward_energy_stream_append", "health_advisories_stream", "dlq_stream",
    "route_enriched_stream", "aqi_emergency_stream", "gridlock_stream", "bus_bunching_stream",
    "signal_lane_high_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    events = city.events(spark, sf_dir).count()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(runs):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "events": events,
        "events_per_second": {name: round(events / s) for name, s in seconds.items()}}))


if __name__ == "__main__":
    main()
