"""Times headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from eventloom import catalog
from eventloom.catalog.etl import old_events
from eventloom.operators.backfill import backfill_events
from eventloom.session import local_session

HEADLINES = [
    "event_daily", "event_hourly", "dau", "user_behavior", "session_analysis", "engagement_kpi_tz", "new_return",
    "retention_daily", "retention_view", "page_view_detail", "exit_page", "acquisition_wh", "traffic_users",
    "lifecycle_state", "meta_event_params", "event_analysis", "event_property", "funnel_table", "funnel_table_events",
    "path_session", "path_gap", "explore_retention", "attribution_linear", "parse_sdk", "traffic_source",
    "extract_users", "extract_sessions", "geo_ip", "parse_ua", "base_view", "merge_sessions", "backfill_event",
    "upsert_replace", "stream_dedupe",
]


def run(spark, fn, sf_dir: str) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(keys: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="eventloom-bench")
    queries = catalog.queries()
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    run(spark, queries["dau"], sf_dir)  # starts the executor threads
    seconds = {key: round(run(spark, queries[key], sf_dir), 3) for key in keys or HEADLINES}
    # The published back-fill starts from stored events of the first layout. Making them from the driver's table
    # (uploads, compression, parsing) is the fixture; it is timed apart.
    start = time.perf_counter()
    old = old_events(spark, sf_dir)
    fixture = time.perf_counter() - start
    moved = run(spark, lambda s, d: backfill_events(old), sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "events": events,
        # The published rate to compare with is about 17,500 events per second.
        "backfill": {"fixture_sec": round(fixture, 3), "sec": round(moved, 3), "events_per_sec": round(events / moved)},
        "backfill_events_per_sec": round(events / moved),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
