import json
import os
import time

import pytest
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators import cells, tables, windows
from fleetpulse.operators.envelopes import classify_requests, observe_counters
from fleetpulse.plans import reads
from fleetpulse.sinks import stores
from fleetpulse.sources import events, scans
from fleetpulse.session import use_stream_settings
from fleetpulse.streaming import jobs
from tests.helpers import NOW_MS, beat, beats, rows_of

T0 = 1_700_000_040_000


class Stage:
    """A message folder; each ``arrive`` is one file and one run of the windows query.

    A late event counts twice in ``dropped``: by the row of its device and by that of its value cell.
    """

    def __init__(self, spark, folder, settings=jobs.StreamSettings()):
        self.spark, self.folder, self.settings = spark, folder, settings
        self.dropped = 0
        use_stream_settings(spark)

    def arrive(self, *events):
        bodies = [json.dumps({"device_id": d, "region": "us", "status": "ok", "latency_ms": 5.0,
                              "timestamp_ms": int(T0 + sec * 1000)}) for sec, d in events]
        self.put(bodies)
        query = jobs.start_windows(scans.file_stream(self.spark, f"{self.folder}/inbox"), f"{self.folder}/out",
                                   f"{self.folder}/checkpoints", self.settings, live=False)
        query.awaitTermination()
        for progress in query.recentProgress:
            self.dropped += sum(o["numRowsDroppedByWatermark"] for o in progress["stateOperators"])
        return self

    def put(self, bodies):
        df = self.spark.createDataFrame([(b,) for b in bodies], "value string")
        df.coalesce(1).write.mode("append").text(f"{self.folder}/inbox")

    def emitted(self):
        try:
            found = scans.aggregate_table(self.spark, f"{self.folder}/out")
            return [((ms - T0) // 1000, n, unique) for ms, n, unique in rows_of(
                found.select(F.unix_millis("window_start").alias("ms"), "count", "distinct_count"),
                "ms", "count", "distinct_count")]
        except Exception as problem:  # noqa: BLE001 - no folder before the first window
            assert "PATH_NOT_FOUND" in str(problem)
            return []


@pytest.fixture
def stage(spark, folder):
    return Stage(spark, folder)


def test_window_stays_open_until_the_bound(stage):
    assert stage.arrive((1, "a")).arrive((89.999, "a")).emitted() == []


def test_window_closes_at_the_bound(stage):
    assert stage.arrive((1, "a")).arrive((90, "a")).emitted() == [(0, 1, 1)]


def test_out_of_order_rows_within_the_bound_count(stage):
    stage.arrive((1, "a"), (2, "b"), (59.999, "a")).arrive((89.999, "z")).arrive((30, "a"))
    stage.arrive((90, "z")).arrive((200, "z"))
    assert stage.emitted()[0] == (0, 4, 2)


def test_a_late_row_in_the_same_file_counts(stage):
    assert stage.arrive((1, "a"), (300, "z"), (2, "b")).emitted()[0] == (0, 2, 2)


def test_a_row_after_close_is_dropped(stage):
    stage.arrive((1, "a")).arrive((90, "z")).arrive((95, "z")).arrive((10, "late")).arrive((200, "z"))
    assert stage.emitted() == [(0, 1, 1), (60, 2, 1)] and stage.dropped == 2


@pytest.mark.parametrize("files, expected, dropped", [
    ([[1], [89.999]], [], 0),
    ([[1], [90]], [(0, 1, 1)], 0),
    ([[1, 300, 2]], [(0, 2, 1)], 0),
    ([[1], [90], [10]], [(0, 2, 1)], 0),
    ([[1], [90], [95], [10], [200]], [(0, 1, 1), (60, 2, 1)], 2),
])
def test_files_as_micro_batches_of_one_run(stage, files, expected, dropped):
    """Within one run a late row still counts in the batch right after the closing one."""
    for seconds in files:
        stage.put([json.dumps({"device_id": "a", "region": "us", "status": "ok", "latency_ms": 1.0,
                               "timestamp_ms": int(T0 + sec * 1000)}) for sec in seconds])
        time.sleep(0.05)
    query = jobs.start_windows(scans.file_stream(stage.spark, f"{stage.folder}/inbox", 1),
                               f"{stage.folder}/out", f"{stage.folder}/checkpoints", live=False)
    query.awaitTermination()
    late = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert (stage.emitted()[:len(expected) or None], late) == (expected, dropped)


def test_idle_source_keeps_its_last_window_and_a_batch_flushes_it(stage):
    stage.arrive((1, "a")).arrive()
    assert stage.emitted() == []
    rows = [beat("a", "us", "ok", T0 + 1000)]
    assert windows.window_aggregate(beats(stage.spark, rows)).count() == 1


def test_extra_tag_from_message_to_read(spark, folder):
    settings = jobs.StreamSettings(dims=(*schema.DIMENSIONS, "device_model"))
    stage = Stage(spark, folder)
    bodies = [{"device_id": "d", "region": "us", "status": "ok", "timestamp_ms": T0 + at, "device_model": m}
              for at, m in ((1, "m1"), (2, "m2"), (3, "m2"), (600_000, "m1"))]
    stage.put([json.dumps(b) for b in bodies])
    jobs.drain(spark, lambda: scans.file_stream(spark, f"{folder}/inbox"), f"{folder}/t", settings)
    tags = ("device_model",)
    stored = scans.aggregate_table(spark, f"{folder}/t/heartbeat_aggregates", tags)
    found = reads.metrics_series(stored, reads.ReadFilter.of(T0, T0 + 60_000, device_model="m2"))
    assert [(r.device_model, r["count"]) for r in found.collect()] == [("m2", 2)]
    raw = scans.raw_table(spark, f"{folder}/t/heartbeats", tags)
    assert rows_of(raw, "device_model") == [("m1",), ("m1",), ("m2",), ("m2",)]
    assert reads.metrics_series(stored, reads.ReadFilter.of(T0, T0 + 60_000)).count() == 2


def test_restart_emits_no_window_again(stage):
    stage.arrive((1, "a")).arrive((90, "a"))
    again = jobs.start_windows(scans.file_stream(stage.spark, f"{stage.folder}/inbox"), f"{stage.folder}/out",
                               f"{stage.folder}/checkpoints", live=False)
    again.awaitTermination()
    assert stage.emitted() == [(0, 1, 1)]


def test_approximate_distinct_stream(spark, folder):
    stage = Stage(spark, folder, jobs.StreamSettings(distinct="approx"))
    assert stage.arrive((1, "a"), (2, "b"), (3, "a")).arrive((90, "a")).emitted() == [(0, 3, 2)]


def test_malformed_messages_vanish_and_raw_keeps_late_rows(spark, folder):
    stage = Stage(spark, folder)
    root, source = f"{folder}/tables", lambda: scans.file_stream(spark, f"{folder}/inbox")
    late = json.dumps({"device_id": "d", "timestamp_ms": T0})
    for bodies in (["not-json", late], [json.dumps({"device_id": "z", "timestamp_ms": T0 + 900_000})],
                   [json.dumps({"device_id": "z", "timestamp_ms": T0 + 910_000})], [late]):
        stage.put(bodies)
        jobs.drain(spark, source, root)
    raw = scans.raw_table(spark, f"{root}/heartbeats")
    assert rows_of(raw, "device_id", "region", "latency_ms") == [
        ("d", "", 0.0), ("d", "", 0.0), ("z", "", 0.0), ("z", "", 0.0)]
    closed = scans.aggregate_table(spark, f"{root}/heartbeat_aggregates")
    assert rows_of(closed, "region", "status", "count") == [("", "", 1)]


def test_one_query_runs_on_when_the_other_fails(spark, folder):
    stage = Stage(spark, folder)
    stage.put([json.dumps({"device_id": "d", "timestamp_ms": T0})])
    os.makedirs(f"{folder}/heartbeats")
    with open(f"{folder}/heartbeats/day=20231114", "w") as blocked:
        blocked.write("a file where the day folder should be")
    queries = jobs.start_pipeline(spark, lambda: scans.file_stream(spark, f"{folder}/inbox"), folder, live=False)
    with pytest.raises(Exception):
        queries["raw"].awaitTermination()
    queries["windows"].awaitTermination()
    assert queries["windows"].exception() is None


def test_validation_is_an_option(spark, folder):
    stage = Stage(spark, folder, jobs.StreamSettings(validate_now_ms=T0 + 10 ** 6))
    stage.put([json.dumps({"device_id": "", "region": "us", "status": "ok", "timestamp_ms": T0})])
    assert stage.arrive((1, "a")).arrive((90, "a")).emitted() == [(0, 1, 1)]


def test_stream_equals_batch(spark, folder):
    stage = Stage(spark, folder)
    plain = [(i * 7 % 170, f"d{i % 6}") for i in range(200)]
    latency = lambda sec, d: 3.0 + sec * 1.7 + len(d)
    stage.put([json.dumps({"device_id": d, "region": "us", "status": "ok", "latency_ms": latency(sec, d),
                           "timestamp_ms": int(T0 + sec * 1000)}) for sec, d in plain])
    stage.arrive().arrive((400, "z"))
    rows = [beat(d, "us", "ok", int(T0 + sec * 1000), latency(sec, d)) for sec, d in plain]
    columns = (F.unix_millis("window_start").alias("ms"), "count", "distinct_count", *schema.PERCENTILES)
    stored = rows_of(scans.aggregate_table(spark, f"{folder}/out"), *columns)
    assert len(stored) == 3
    assert stored == rows_of(windows.window_aggregate(beats(spark, rows), quantiles="cells"), *columns)
    exact = rows_of(windows.window_aggregate(beats(spark, rows)), *columns)
    for mine, other in zip(stored, exact):
        assert mine[:3] == other[:3]
        assert all(abs(a - b) <= b * cells.RELATIVE_ERROR for a, b in zip(mine[3:], other[3:]))


def test_a_replayed_micro_batch_collapses_on_read(stage):
    stage.arrive((1, "a")).arrive((90, "a"))
    stored = scans.aggregate_table(stage.spark, f"{stage.folder}/out")
    twice = stored.unionByName(stored)
    assert tables.latest_version(twice).count() == 1


def test_database_sinks_get_rows_and_batch_sizes(spark, folder, monkeypatch):
    """No database runs here: the JDBC write is replaced by files."""
    def kept(rows, url, table, driver, batch_rows):
        assert (url, driver, batch_rows) == ("jdbc:x", "d", {"heartbeats": 1000, "heartbeat_aggregates": 500}[table])
        rows.write.mode("append").parquet(f"{folder}/{table}")

    monkeypatch.setattr(stores, "append_jdbc", kept)
    stage = Stage(spark, folder)
    stage.put([json.dumps({"device_id": "d", "timestamp_ms": T0 + at}) for at in (0, 1, 600_000)])
    source = scans.file_stream(spark, f"{folder}/inbox")
    jobs.start_raw_jdbc(source, "jdbc:x", "d", f"{folder}/c1", live=False).awaitTermination()
    jobs.start_windows_jdbc(source, "jdbc:x", "d", f"{folder}/c2", live=False).awaitTermination()
    raw = spark.read.parquet(f"{folder}/heartbeats")
    assert raw.count() == 3 and raw.columns == [c for c in schema.RAW_TABLE.fieldNames() if c != "day"]
    closed = spark.read.parquet(f"{folder}/heartbeat_aggregates")
    assert closed.columns == schema.AGGREGATE_TABLE.fieldNames()[:10]
    assert rows_of(closed, "count") == [(2,)]


def test_parquet_datasets_as_streams(spark, folder, sf_dir):
    def streamed(path, shape, name):
        query = (scans.parquet_stream(spark, path, shape).writeStream.format("memory").queryName(name)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return spark.table(name).count()

    beats(spark, [beat()] * 3).write.parquet(f"{folder}/dataset")
    assert streamed(f"{folder}/dataset", schema.HEARTBEAT, "folder_dataset") == 3
    one_file = f"{sf_dir}/events.parquet"
    assert streamed(one_file, events.EVENTS, "file_dataset") == spark.read.parquet(one_file).count()


def test_stream_needs_bounded_percentiles(spark, folder):
    messages = spark.readStream.schema("value string").text(folder)
    timed = windows.with_watermark(jobs.heartbeats_of(messages, jobs.StreamSettings()))
    with pytest.raises(ValueError):
        windows.window_aggregate(timed, quantiles="exact")


def test_ingest_stream_publishes_accepted_and_reports_counters(spark, folder):
    good = {"device_id": "d", "region": "us", "status": "ok", "timestamp_ms": NOW_MS, "latency_ms": 1.0}
    spark.createDataFrame([
        ("a", "batch", json.dumps({"heartbeats": [good, good]})), ("b", "single", "{not json"),
        ("c", "batch", json.dumps({"heartbeats": [good, {**good, "region": ""}]})),
    ], schema.REQUEST).write.json(f"{folder}/requests")
    events = jobs.ingest_stream(scans.request_stream(spark, f"{folder}/requests"), NOW_MS)
    query = (events.writeStream.format("parquet").option("path", f"{folder}/events")
             .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/events").count() == 2
    seen = query.recentProgress[0]["observedMetrics"]["ingest_counters"]
    assert (seen["accepted_total"], seen["rejected_total"]) == (2, 3)
    batch = observe_counters(classify_requests(scans.request_rows(spark, f"{folder}/requests"), NOW_MS))
    assert batch.count() == 3


def test_a_drained_run_leaves_its_state_as_files(spark, stage, folder):
    """Windows of a day close in one run; the next starts from the state still held, of runs of either kind."""
    def run(live, *events):
        use_stream_settings(spark, live=live)
        return stage.arrive(*events)

    def kinds():
        names = [name for _, _, found in os.walk(f"{folder}/checkpoints/state") for name in found]
        return {end for end in ("zip", "changelog") if any(n.endswith(end) and not n.startswith(".") for n in names)}

    run(False, (1, "a"), (70, "a"), (71, "b"))
    assert kinds() == {"zip"}
    run(False, (130, "c"), (86_400, "z"))
    assert stage.emitted() == [(0, 1, 1), (60, 2, 2), (120, 1, 1)]
    run(True, (86_401, "y"))
    run(False, (86_402, "z"), (86_500, "x"), (5, "late"))
    assert stage.dropped == 2 and stage.emitted()[3:] == [(86_400, 3, 2)] and kinds() == {"zip", "changelog"}


def test_drain_starts_from_files_of_state(spark, stage, folder):
    for sec in (1, 4000, 8000):
        stage.put([json.dumps({"device_id": "d", "region": "us", "status": "ok", "latency_ms": 5.0,
                               "timestamp_ms": T0 + sec * 1000})])
        jobs.drain(spark, lambda: scans.file_stream(spark, f"{folder}/inbox"), folder)
    names = [name for _, _, found in os.walk(f"{folder}/checkpoints/windows/state") for name in found]
    assert any(n.endswith(".zip") for n in names) and not any(n.endswith(".changelog") for n in names)
    stored = scans.aggregate_table(spark, f"{folder}/heartbeat_aggregates")
    assert rows_of(stored, "count") == [(1,), (1,)]
