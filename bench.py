"""Headline timings at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local threads.
Each query runs once unmeasured, then ``BENCH_RUNS`` times; the median counts.
"""

import json
import os
import statistics
import sys
import time

from fleetpulse.operators import windows
from fleetpulse.plans import catalog, reads
from fleetpulse.session import build_session, pin_utc, scratch_path
from fleetpulse.sinks import stores
from fleetpulse.sources import events, scans
from fleetpulse.streaming import jobs, state

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

REGISTERED = (
    "decode_heartbeats", "envelope_outcomes", "validate_rejected",
    "window_1m", "window_1h", "window_1d", "nearest_rank_percentiles",
    "dashboard_week", "metrics_series", "distinct_devices", "fleet_rollup",
    "region_series", "latest_versions", "kll_percentile_check",
)
STREAMED = ("stream_window_1h", "stream_raw_copy")


def timed(action):
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def stored_actions(spark):
    """Build both tables once, then read them the way the API does."""
    root = scratch_path(spark, "bench")
    beats = events.heartbeats(spark, SF_DIR)
    raw_path, agg_path = f"{root}/heartbeats", f"{root}/heartbeat_aggregates"
    minute = windows.window_aggregate(beats, catalog.MINUTE)
    build = {
        "store_raw": timed(lambda: stores.append_raw(beats, raw_path)),
        "store_windows_1m": timed(lambda: stores.append_aggregates(minute, agg_path)),
    }
    raw, aggs = scans.raw_table(spark, raw_path), scans.aggregate_table(spark, agg_path)
    week = reads.ReadFilter.of(catalog.WEEK_FROM_MS, catalog.WEEK_TO_MS)
    return build, {
        "stored_metrics": lambda: drain(reads.metrics_series(aggs, week)),
        "stored_distinct": lambda: drain(reads.distinct_devices(raw, week)),
        "stored_dashboard": lambda: drain(reads.dashboard(aggs, raw, week)[0]),
        "stored_fleet_rollup": lambda: drain(
            reads.fleet_rollup(aggs, catalog.AS_OF_MS, catalog.MONTH_MINUTES)),
        "sketch_windows_1m": lambda: drain(windows.window_aggregate(
            beats, catalog.MINUTE, quantiles="sketch", distinct="approx")),
    }


def only_the_result_on_stdout():
    """Point file descriptor 1 at stderr for Spark and its JVM; give the real one back."""
    real = os.fdopen(os.dup(1), "w")
    os.dup2(sys.stderr.fileno(), 1)
    return real


def main():
    out = only_the_result_on_stdout()
    spark = pin_utc(build_session("fleetpulse-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}))
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.registered()
    results, actions = stored_actions(spark)
    for name in REGISTERED:
        actions[name] = lambda q=queries[name]: drain(q(spark, SF_DIR))
    for name, action in actions.items():
        action()
        results[name] = statistics.median(timed(action) for _ in range(RUNS))
    for name in STREAMED:
        for _ in range(2):
            results[name] = timed(lambda: drain(queries[name](spark, SF_DIR)))
    root = scratch_path(spark, "bench-stream")
    drained = jobs.drain(spark, lambda: events.message_stream(spark, SF_DIR), root,
                         jobs.StreamSettings(window_seconds=catalog.HOUR))
    rows = events.heartbeats(spark, SF_DIR).count()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": {name: round(sec, 3) for name, sec in results.items()},
        "sf": SF_DIR.rstrip("/").rsplit("/sf", 1)[-1], "events": rows,
        "window_1m_events_per_sec": round(rows / results["window_1m"]),
        "stream_events_per_sec": round(rows / results["stream_window_1h"]),
        "stream_state": state.state_progress(drained["windows"]),
    }), file=out, flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
