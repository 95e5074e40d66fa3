"""The registered queries: every operator over the whole test tables.

Results carry times as epoch ms and rounded floats, so that they compare by value.
"""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import epoch_ms, text_or_empty
from fleetpulse.operators import (
    cells, decode, device_layout, device_sets, envelopes, sketches, tables, validate, windows,
)
from fleetpulse.operators.percentiles import grouped_percentiles, nearest_rank_percentiles
from fleetpulse.plans import reads, repair
from fleetpulse.session import pin_utc, saved, scratch_path
from fleetpulse.sinks import stores
from fleetpulse.sources import events, scans
from fleetpulse.streaming import jobs, state

MINUTE, HOUR, DAY = 60, 3600, 86_400
AS_OF_MS = events.AS_OF_MS
WEEK_FROM_MS, WEEK_TO_MS = 1_704_672_000_000, 1_705_276_800_000
EMPTY_FROM_MS, EMPTY_TO_MS = 1_893_456_000_000, 1_893_542_400_000
MONTH_MINUTES = 40 * 24 * 60
RETENTION_AS_OF_MS = 1_713_139_200_000
DASHBOARD_LIMIT = 300
HISTORY_DEVICE = "dev-8"
LIFE_DAYS = 10
LIMITS = {"max_body_bytes": events.SMALL_BODY, "max_batch": events.SMALL_BATCH}


def rounded(df):
    """Means to nine decimals, percentiles to six: beyond summation noise, short of ties."""
    digits = {c: 6 if c.startswith("p") else 9
              for c, kind in df.dtypes if kind == "double" and c != "latency_ms"}
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])


def with_ms(df):
    """Timestamps as epoch-ms columns of the same name plus ``_ms``."""
    return df.select(*[epoch_ms(c).alias(f"{c}_ms") if kind == "timestamp" else F.col(c)
                       for c, kind in df.dtypes])


def _minutes(spark, sf, from_ms=None, to_ms=None):
    return windows.window_aggregate(events.heartbeats(spark, sf, from_ms, to_ms), MINUTE)


# --- decode and publish

def decode_heartbeats(spark, sf):
    messages = events.faulty_messages(events.heartbeats(spark, sf))
    rows = decode.decode_heartbeats(messages, keep=("event_id",))
    return rows.select("event_id", *[text_or_empty(F.col(c)).alias(c) for c in schema.TEXT_FIELDS],
                       *schema.NUMBER_FIELDS)


def dead_letters(spark, sf):
    return decode.dead_letters(events.faulty_messages(events.heartbeats(spark, sf)))


def published_messages(spark, sf):
    return stores.as_messages(events.heartbeats(spark, sf))


# --- requests

def _classified(spark, sf):
    requests = events.requests(events.heartbeats(spark, sf))
    return envelopes.classify_requests(requests, AS_OF_MS, **LIMITS)


def envelope_outcomes(spark, sf):
    return _classified(spark, sf).drop("events")


def envelope_accepted_events(spark, sf):
    return envelopes.accepted_events(_classified(spark, sf))


def ingest_counters(spark, sf):
    return envelopes.outcome_counters(_classified(spark, sf))


# --- validation

def _faulty(spark, sf):
    return events.faulty_heartbeats(events.heartbeats(spark, sf))


def validate_accepted(spark, sf):
    return validate.accepted(_faulty(spark, sf), AS_OF_MS)


def validate_rejected(spark, sf):
    return validate.quarantined(_faulty(spark, sf), AS_OF_MS)


def reject_reason_counts(spark, sf):
    return validate.reason_counts(_faulty(spark, sf), AS_OF_MS)


# --- windows

def _window_query(seconds):
    def query(spark, sf):
        return rounded(with_ms(windows.window_aggregate(events.heartbeats(spark, sf), seconds)))
    return query


def window_sparse(spark, sf):
    """Windows of events of which many lack a latency, a time or a device."""
    beats = events.heartbeats(spark, sf, keep=("event_id",))
    lacking = beats.select("event_id", "region", "status", *[
        F.when(F.col("event_id") % 10 != at, F.col(name)).alias(name)
        for at, name in enumerate(("latency_ms", "timestamp_ms", "device_id"))])
    return rounded(with_ms(windows.window_aggregate(lacking, HOUR)))


def window_by_extra_dim(spark, sf):
    beats = events.heartbeats(spark, sf, keep=("event_id", "user_id"))
    tagged = beats.withColumn("device_model", F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")))
    return rounded(with_ms(windows.window_aggregate(
        tagged, DAY, (*schema.DIMENSIONS, "device_model"))))


def nearest_rank(spark, sf):
    beats = events.heartbeats(spark, sf)
    points = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    return nearest_rank_percentiles(beats, ["region", "status"], "latency_ms", points)


def latency_percentiles_by_cells(spark, sf):
    """Exact percentiles per region and status, found the way large groups are."""
    found = grouped_percentiles(events.heartbeats(spark, sf), ["region", "status"], "latency_ms",
                                schema.PERCENTILES, group_rows=0)
    return rounded(found)


# --- streams

def _drained(spark, sf, label):
    root = scratch_path(pin_utc(spark), label)
    settings = jobs.StreamSettings(window_seconds=HOUR)
    jobs.drain(spark, lambda: events.message_stream(spark, sf), root, settings)
    return root, settings


def _stored_windows(spark, root):
    stored = scans.aggregate_table(spark, f"{root}/heartbeat_aggregates")
    return rounded(with_ms(stored.drop("ingested_at", "batch_id", "day")))


def stream_window_1h(spark, sf):
    root, _ = _drained(spark, sf, "stream-windows")
    return _stored_windows(spark, root)


def stream_raw_copy(spark, sf):
    root, _ = _drained(spark, sf, "stream-raw")
    return with_ms(scans.raw_table(spark, f"{root}/heartbeats"))


def stream_restart_no_duplicates(spark, sf):
    """Stop and start again on the same checkpoints: rows as stored, not collapsed."""
    root, settings = _drained(spark, sf, "stream-restart")
    jobs.drain(spark, lambda: events.message_stream(spark, sf), root, settings)
    return _stored_windows(spark, root)


def stream_late_dropped(spark, sf):
    """The whole table arrives, arrives once more, then a row a day later closes all windows.

    On its second arrival a row of a closed window is dropped; one of a window
    still open is counted again.
    """
    root = scratch_path(pin_utc(spark), "stream-late")
    inbox, settings = f"{root}/inbox", jobs.StreamSettings(window_seconds=HOUR)
    beats = events.heartbeats(spark, sf)
    closing = beats.agg(*[F.max_by(c, "timestamp_ms").alias(c) for c in beats.columns]).withColumn(
        "timestamp_ms", F.col("timestamp_ms") + 1000 * DAY)
    for arrival in (beats, beats, closing):
        stores.as_messages(arrival).select("value").write.mode("append").text(inbox)
        jobs.use_stream_settings(spark, live=False)
        jobs.start_windows(scans.file_stream(spark, inbox), f"{root}/heartbeat_aggregates",
                           f"{root}/checkpoints", settings, live=False).awaitTermination()
    return _stored_windows(spark, root)


def repaired_windows(spark, sf):
    """Every event arrives a second time after its window has closed; the windows are then repaired
    from the raw table, in which nothing is late. The last arrival is one event a day after all others."""
    root = scratch_path(pin_utc(spark), "repair")
    inbox, settings = f"{root}/inbox", jobs.StreamSettings(window_seconds=HOUR)
    beats = events.heartbeats(spark, sf)
    closing = beats.agg(*[F.max_by(c, "timestamp_ms").alias(c) for c in beats.columns]).withColumn(
        "timestamp_ms", F.col("timestamp_ms") + 1000 * DAY)
    for arrival in (beats, closing, beats):
        stores.as_messages(arrival).select("value").write.mode("append").text(inbox)
        jobs.drain(spark, lambda: scans.file_stream(spark, inbox), root, settings)
    raw = scans.raw_table(spark, f"{root}/heartbeats")
    closed_ms = raw.agg(F.unix_millis(F.max("event_time"))).first()[0] // (1000 * HOUR) * (1000 * HOUR)
    path = f"{root}/heartbeat_aggregates"
    repair.repair_windows(spark, path, scans.aggregate_table(spark, path), raw, 0, closed_ms, HOUR, batch_id=10**6)
    return _newest_windows(spark, root)


def _newest_windows(spark, root):
    newest = tables.latest_version(scans.aggregate_table(spark, f"{root}/heartbeat_aggregates"))
    return rounded(with_ms(newest.drop("ingested_at", "batch_id", "day")))


def stream_open_windows(spark, sf):
    """The windows a drained stream still holds, read from its state."""
    root, settings = _drained(spark, sf, "stream-open")
    return rounded(with_ms(state.open_windows(spark, f"{root}/checkpoints/windows", settings.window_seconds)))


def stream_two_parts(spark, sf):
    """Closed windows of a source of two parts: the odd devices' events arrive ten days behind
    the even ones', yet none is late. The last arrival is one event a day after all others in each part.
    """
    root = scratch_path(pin_utc(spark), "stream-parts")
    beats = events.heartbeats(spark, sf)
    span = beats.agg(F.min("timestamp_ms").alias("first"), *[F.max_by(c, "timestamp_ms").alias(c) for c in beats.columns])
    closing = span.select(*beats.columns).withColumn("timestamp_ms", F.col("timestamp_ms") + 1000 * DAY)
    part = F.substring_index("device_id", "-", -1).cast("long") % 2
    third = F.least(F.floor((F.col("timestamp_ms") - F.col("first")) / (10_000 * DAY)), F.lit(2))
    arrivals = saved(beats.join(F.broadcast(span.select("first"))).withColumns(
        {"part": part, "arrival": third + part}).drop("first"), "arrivals")
    folders = [f"{root}/part-{number}" for number in range(2)]
    jobs.use_stream_settings(spark, live=False)
    for arrival in range(5):
        for number, folder in enumerate(folders):
            rows = closing if arrival == 4 else arrivals.where((F.col("part") == number) & (F.col("arrival") == arrival))
            stores.as_messages(rows).select("value").write.mode("append").text(folder)
        jobs.start_windows(scans.file_parts(spark, folders), f"{root}/heartbeat_aggregates", f"{root}/checkpoints",
                           jobs.StreamSettings(window_seconds=HOUR), live=False).awaitTermination()
    return _stored_windows(spark, root)


def raw_table_life(spark, sf):
    """A raw table through its life: three arrivals by stream, one day added again by a batch,
    old days expired, loads merged in place, then read."""
    root = scratch_path(pin_utc(spark), "raw-life")
    inbox, path = f"{root}/inbox", f"{root}/heartbeats"
    beats = events.heartbeats(spark, sf)
    jobs.use_stream_settings(spark, live=False)
    for arrival in range(3):
        part = beats.where(F.pmod("event_id", F.lit(3)) == arrival)
        stores.as_messages(part).select("value").write.mode("append").text(inbox)
        jobs.start_raw_copy(scans.file_stream(spark, inbox), path, f"{root}/checkpoint",
                            live=False).awaitTermination()
    stores.append_raw(events.heartbeats(spark, sf, WEEK_FROM_MS, WEEK_FROM_MS + 1000 * DAY), path)
    stores.drop_expired_days(spark, path, WEEK_TO_MS, LIFE_DAYS)
    stores.merge_raw_days(spark, path)
    return with_ms(scans.raw_table(spark, path))


# --- stored tables

def raw_table_rows(spark, sf):
    return with_ms(tables.raw_rows(events.heartbeats(spark, sf)))


def stored_raw_week(spark, sf):
    """Write the raw table by day, read one week of it back."""
    week = tables.in_time_range(_stored_raw(spark, sf), "event_time", WEEK_FROM_MS, WEEK_TO_MS)
    return with_ms(week)


def _versions(spark, sf):
    hourly = windows.window_aggregate(events.heartbeats(spark, sf), HOUR)
    versions = events.aggregate_versions(hourly)
    return versions.withColumn("day", tables.day_key(F.col("window_start")))


def latest_versions(spark, sf):
    return rounded(with_ms(tables.latest_version(_versions(spark, sf))))


def _stored_versions(spark, sf):
    """All versions of the hourly windows, written by day and scanned."""
    path = scratch_path(pin_utc(spark), "versions")
    rows = tables.lay_out_by_day(_versions(spark, sf), schema.AGGREGATE_KEY)
    rows.write.partitionBy("day").parquet(path)
    return scans.aggregate_table(spark, path)


def _stored_raw(spark, sf):
    path = scratch_path(pin_utc(spark), "raw-table")
    stores.append_raw(events.heartbeats(spark, sf), path)
    return scans.raw_table(spark, path)


def _compacted(spark, sf):
    path = scratch_path(pin_utc(spark), "compaction")
    stores.compact_days(_stored_versions(spark, sf), path)
    return scans.aggregate_table(spark, path)


def compacted_rows(spark, sf):
    """The rows a compaction of every day leaves, in full."""
    return rounded(with_ms(_compacted(spark, sf)))


def compacted_days(spark, sf):
    """Write all versions, compact every day, count what is stored per day."""
    return _compacted(spark, sf).groupBy("day").agg(F.count("*").alias("rows"), F.sum("count").alias("events"),
                                     F.sum("batch_id").alias("batches"))


def compacted_incremental(spark, sf):
    """All versions arrive in two parts; each is followed by a compaction of the days it touched."""
    root = scratch_path(pin_utc(spark), "incremental")
    versions, days = saved(_versions(spark, sf), "versions"), []
    for part in (F.col("batch_id") == 0, F.col("batch_id") > 0):
        rows = tables.lay_out_by_day(versions.where(part), schema.AGGREGATE_KEY)
        rows.write.mode("append").partitionBy("day").parquet(f"{root}/versions")
        days.append(stores.compact_new_days(spark, f"{root}/versions", f"{root}/compacted", f"{root}/mark"))
    return rounded(with_ms(scans.aggregate_table(spark, f"{root}/compacted")))


def tags_added_later(spark, sf):
    """Daily windows by a tag that the raw table's first days do not have."""
    path = scratch_path(pin_utc(spark), "later-tags")
    beats = events.heartbeats(spark, sf, keep=("event_id", "user_id")).withColumn(
        "device_model", F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")))
    stores.append_raw(beats.where(F.col("timestamp_ms") < WEEK_FROM_MS), path)
    stores.append_raw(beats.where(F.col("timestamp_ms") >= WEEK_FROM_MS), path, ("device_model",))
    tags = scans.stored_tags(spark, path)
    raw = scans.raw_table(spark, path, tags)
    return rounded(with_ms(windows.window_aggregate(raw, DAY, (*schema.DIMENSIONS, *tags))))


def retention_raw(spark, sf):
    raw = tables.raw_rows(events.heartbeats(spark, sf))
    return with_ms(tables.unexpired_raw(raw, AS_OF_MS))


def retention_aggregates(spark, sf):
    hourly = windows.window_aggregate(events.heartbeats(spark, sf), HOUR)
    return rounded(with_ms(tables.unexpired_aggregates(hourly, RETENTION_AS_OF_MS)))


# --- reads

def _week(**more):
    return reads.ReadFilter.of(WEEK_FROM_MS, WEEK_TO_MS, **more)


def metrics_series(spark, sf):
    found = reads.metrics_series(
        _minutes(spark, sf, WEEK_FROM_MS, WEEK_TO_MS), _week())
    return rounded(found)


def metrics_series_filtered(spark, sf):
    found = reads.metrics_series(_minutes(spark, sf, WEEK_FROM_MS, WEEK_TO_MS),
                                 _week(region="us-east", status="ok"))
    return rounded(found)


def stored_metrics(spark, sf):
    """A week's series from the stored, versioned table."""
    return rounded(reads.metrics_series(_stored_versions(spark, sf), _week()))


def stored_dashboard(spark, sf):
    """A week's dashboard from both stored tables."""
    summary, _ = reads.dashboard(_stored_versions(spark, sf), _stored_raw(spark, sf), _week())
    return rounded(summary)


def stored_fleet_rollup(spark, sf):
    return reads.fleet_rollup(_stored_versions(spark, sf), AS_OF_MS, MONTH_MINUTES)


def sql_view_rollup(spark, sf):
    """SQL text over the stored tables: a week per region, with its devices."""
    reads.register_views(_stored_versions(spark, sf), _stored_raw(spark, sf))
    return spark.sql(f"""SELECT region, status, events, peak_unique_devices, devices
        FROM (SELECT region, status, sum(count) AS events, max(distinct_count) AS peak_unique_devices
              FROM windows_between({WEEK_FROM_MS}, {WEEK_TO_MS}) GROUP BY region, status)
        JOIN (SELECT region, status, count(DISTINCT device_id) AS devices
              FROM heartbeats_between({WEEK_FROM_MS}, {WEEK_TO_MS}) GROUP BY region, status)
        USING (region, status)""")


def message_folder_read(spark, sf):
    """All messages of a folder, read at once and decoded."""
    inbox = scratch_path(pin_utc(spark), "inbox")
    stores.as_messages(events.heartbeats(spark, sf)).select("value").write.text(inbox)
    rows = decode.decode_heartbeats(scans.file_batch(spark, inbox))
    return rows.select(*schema.TEXT_FIELDS, *schema.NUMBER_FIELDS)


def export_roundtrip(spark, sf):
    """Hourly counts as result files of each form, read back."""
    hourly = saved(with_ms(windows.window_aggregate(events.heartbeats(spark, sf), HOUR)).select(
        "window_start_ms", "region", "status", "count", "p50_latency"), "export-rows")
    back = None
    for form in ("json", "csv", "tsv", "parquet"):
        path = scratch_path(spark, f"export-{form}")
        stores.export_rows(hourly, path, form)
        rows = scans.exported_rows(spark, path, hourly.schema, form).withColumn("form", F.lit(form))
        back = rows if back is None else back.unionByName(rows)
    return rounded(back)


def distinct_devices(spark, sf):
    raw = tables.raw_rows(events.heartbeats(spark, sf, WEEK_FROM_MS, WEEK_TO_MS))
    return reads.distinct_devices(raw, _week(status="warn"))


def _device_sets(spark, sf):
    """Device sets of hourly windows, stored from two halves of the events, the dictionary extended between."""
    beats, path = events.heartbeats(spark, sf), scratch_path(pin_utc(spark), "device-sets")
    dictionary = None
    for half in (beats.where(F.col("timestamp_ms") < WEEK_FROM_MS), beats.where(F.col("timestamp_ms") >= WEEK_FROM_MS)):
        dictionary = saved(device_sets.device_dictionary(half, dictionary), "devices")
        device_sets.device_sets(half, dictionary, HOUR).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def distinct_devices_merged(spark, sf):
    """The week's distinct devices from stored sets alone."""
    week = tables.in_time_range(_device_sets(spark, sf), "window_start", WEEK_FROM_MS, WEEK_TO_MS)
    return device_sets.merged_distinct(week.where(F.col("status") == "warn"))


def distinct_devices_by_region_merged(spark, sf):
    """Distinct devices per region over all time from stored sets alone."""
    return device_sets.merged_distinct(_device_sets(spark, sf), ["region"])


def _dashboard(spark, sf, wanted, **more):
    raw = tables.raw_rows(events.heartbeats(spark, sf, wanted.from_ms, wanted.to_ms))
    summary, _ = reads.dashboard(
        _minutes(spark, sf, wanted.from_ms, wanted.to_ms), raw, wanted, **more)
    return rounded(summary)


def dashboard(spark, sf):
    return _dashboard(spark, sf, _week(limit=DASHBOARD_LIMIT), totals_of_series=True)


def dashboard_week(spark, sf):
    return _dashboard(spark, sf, _week())


def dashboard_empty(spark, sf):
    return _dashboard(spark, sf, reads.ReadFilter.of(EMPTY_FROM_MS, EMPTY_TO_MS))


def fleet_rollup(spark, sf):
    return reads.fleet_rollup(_minutes(spark, sf), AS_OF_MS, MONTH_MINUTES)


def region_series(spark, sf):
    return rounded(with_ms(reads.region_series(_minutes(spark, sf), AS_OF_MS, MONTH_MINUTES)))


def latest_windows_top20(spark, sf):
    return reads.latest_windows(_minutes(spark, sf), AS_OF_MS, MONTH_MINUTES, 20)


def agg_row_count(spark, sf):
    return reads.stored_rows(_versions(spark, sf))


def device_history(spark, sf):
    raw = tables.raw_rows(events.heartbeats(spark, sf))
    return with_ms(reads.device_history(raw, HISTORY_DEVICE, 1, AS_OF_MS))


def device_history_by_curve(spark, sf):
    """The same rows from a copy of the raw table that is laid out by device and time."""
    path = scratch_path(pin_utc(spark), "by-device")
    device_layout.store_by_device(tables.raw_rows(events.heartbeats(spark, sf)), path)
    return with_ms(device_layout.device_rows(spark, path, HISTORY_DEVICE, 1, AS_OF_MS))


def device_windows(spark, sf):
    hourly = windows.window_aggregate(events.heartbeats(spark, sf), HOUR)
    return reads.device_windows(hourly, 1, AS_OF_MS, by=("region",))


# --- approximations against exact results

# Copies of each event, so that groups leave the range in which the sketches are exact.
COPIES = 50
SMALL_KLL, KLL_RANKS_OFF = 100, 0.04
SMALL_ACCURACY = 50
SMALL_HLL, HLL_OFF = 10, 0.10
DEVICE_COPIES, SMALL_THETA, THETA_OFF = 197, 8, 0.25


def _multiplied(spark, sf):
    """Each event fifty times, with other devices and latencies up to 4.9 percent higher."""
    beats = events.heartbeats(spark, sf).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    return beats.withColumns({
        "device_id": F.concat_ws("-", "device_id", "copy"),
        "latency_ms": F.col("latency_ms") * (F.lit(1.0) + F.col("copy") / F.lit(1000.0))})


def _rank_checked(beats, found, keys, tolerance):
    """Exact values, and whether all estimates lie within ``tolerance`` of their rank."""
    met = beats.join(F.broadcast(found), list(keys))
    ok = F.lit(True)
    for name, p in schema.PERCENTILES.items():
        below, to_here = (F.avg(side.cast("int")) for side in (
            F.col("latency_ms") < F.col(f"est_{name}"), F.col("latency_ms") <= F.col(f"est_{name}")))
        ok = ok & (below <= p + tolerance) & (to_here >= p - tolerance)
    exact = grouped_percentiles(beats, list(keys), "latency_ms", schema.PERCENTILES, "nearest")
    return rounded(exact.join(met.groupBy(*keys).agg(ok.alias("within_tol")), list(keys)))


def approx_percentile_check(spark, sf):
    beats = _multiplied(spark, sf)
    points = F.percentile_approx("latency_ms", F.array(*[F.lit(p) for p in schema.PERCENTILES.values()]),
                                 SMALL_ACCURACY)
    found = beats.groupBy("region", "status").agg(points.alias("points")).select(
        "region", "status",
        *[F.col("points")[i].alias(f"est_{n}") for i, n in enumerate(schema.PERCENTILES)])
    return _rank_checked(beats, found, ("region", "status"), 1 / SMALL_ACCURACY)


def kll_percentile_check(spark, sf):
    beats = _multiplied(spark, sf)
    stored = windows.sketch_windows(beats, DAY, k=SMALL_KLL)
    merged = sketches.merge_sketch_rows(stored, ["region"], k=SMALL_KLL)
    found = merged.select("region", *[F.col(n).alias(f"est_{n}") for n in schema.PERCENTILES])
    return _rank_checked(beats, found, ("region",), KLL_RANKS_OFF)


def hll_distinct_check(spark, sf):
    beats = _multiplied(spark, sf)
    merged = sketches.merge_sketch_rows(windows.sketch_windows(beats, DAY, log2_buckets=SMALL_HLL), ["region"])
    exact = beats.groupBy("region").agg(F.count_distinct("device_id").alias("distinct_count"))
    near = F.abs(F.col("found") - F.col("distinct_count")) <= F.col("distinct_count") * HLL_OFF
    found = merged.select("region", F.col("distinct_count").alias("found"))
    return exact.join(found, "region").select("region", "distinct_count", near.alias("within_tol"))


def devices_missing_check(spark, sf):
    """Devices of the time before the week that are missing in it, exactly and by sketches of a few entries."""
    beats = events.heartbeats(spark, sf).withColumn(
        "device_id", F.concat_ws("-", "device_id", F.col("event_id") % DEVICE_COPIES))
    early = F.col("timestamp_ms") < WEEK_FROM_MS
    week = F.col("timestamp_ms").between(WEEK_FROM_MS, WEEK_TO_MS - 1)
    found = sketches.devices_missing(beats, ["region"], early, week, SMALL_THETA)
    seen = beats.groupBy("region", "device_id").agg(F.bool_or(early).alias("early"), F.bool_or(week).alias("week"))
    exact = seen.groupBy("region").agg(F.count_if(F.col("early") & ~F.col("week")).alias("missing"),
                                       F.count_if(F.col("early") | F.col("week")).alias("both"))
    near = F.abs(F.col("devices_missing") - F.col("missing")) <= F.col("both") * THETA_OFF
    return exact.join(found, "region").select("region", "missing", "both", near.alias("within_tol"))


def cell_percentile_check(spark, sf):
    """Percentiles of merged value cells against exact ones, in groups of some 100,000 rows and more."""
    beats = _multiplied(spark, sf)
    merged = cells.merge_cell_rows(windows.cell_windows(beats, DAY), ["region"])
    points = {f"exact_{n}": p for n, p in schema.PERCENTILES.items()}
    exact = grouped_percentiles(beats, ["region"], "latency_ms", points, group_rows=0)
    observed = grouped_percentiles(beats, ["region"], "latency_ms", schema.PERCENTILES, "nearest", group_rows=0)
    ok = F.lit(True)
    for name in schema.PERCENTILES:
        off = F.abs(F.col(f"est_{name}") - F.col(f"exact_{name}"))
        ok = ok & (off <= F.abs(F.col(f"exact_{name}")) * cells.RELATIVE_ERROR)
    found = merged.select("region", "count", *[F.col(n).alias(f"est_{n}") for n in schema.PERCENTILES])
    both = found.join(exact, "region").join(observed, "region")
    return rounded(both.select("region", "count", *schema.PERCENTILES, ok.alias("within_tol")))


def window_1h_cells(spark, sf):
    """Hourly windows of a batch by the stream's percentile state."""
    return rounded(with_ms(windows.window_aggregate(events.heartbeats(spark, sf), HOUR, quantiles="cells")))


def cells_rolled_up(spark, sf):
    """Percentiles of the whole per region and status, from the stored histograms of hourly windows."""
    path = scratch_path(pin_utc(spark), "cell-windows")
    windows.cell_windows(events.heartbeats(spark, sf), HOUR).write.parquet(path)
    return rounded(cells.merge_cell_rows(spark.read.parquet(path), ["region", "status"]))


QUERIES = {
    "decode_heartbeats": decode_heartbeats,
    "dead_letters": dead_letters,
    "published_messages": published_messages,
    "envelope_outcomes": envelope_outcomes,
    "envelope_accepted_events": envelope_accepted_events,
    "ingest_counters": ingest_counters,
    "validate_accepted": validate_accepted,
    "validate_rejected": validate_rejected,
    "reject_reason_counts": reject_reason_counts,
    "window_1m": _window_query(MINUTE),
    "window_1h": _window_query(HOUR),
    "window_1d": _window_query(DAY),
    "window_sparse": window_sparse,
    "window_by_extra_dim": window_by_extra_dim,
    "nearest_rank_percentiles": nearest_rank,
    "latency_percentiles_by_cells": latency_percentiles_by_cells,
    "stream_window_1h": stream_window_1h,
    "stream_raw_copy": stream_raw_copy,
    "stream_restart_no_duplicates": stream_restart_no_duplicates,
    "stream_late_dropped": stream_late_dropped,
    "repaired_windows": repaired_windows,
    "stream_open_windows": stream_open_windows,
    "stream_two_parts": stream_two_parts,
    "raw_table_life": raw_table_life,
    "raw_table_rows": raw_table_rows,
    "stored_raw_week": stored_raw_week,
    "latest_versions": latest_versions,
    "compacted_days": compacted_days,
    "compacted_rows": compacted_rows,
    "compacted_incremental": compacted_incremental,
    "tags_added_later": tags_added_later,
    "retention_raw": retention_raw,
    "retention_aggregates": retention_aggregates,
    "metrics_series": metrics_series,
    "metrics_series_filtered": metrics_series_filtered,
    "stored_metrics": stored_metrics,
    "stored_dashboard": stored_dashboard,
    "stored_fleet_rollup": stored_fleet_rollup,
    "sql_view_rollup": sql_view_rollup,
    "message_folder_read": message_folder_read,
    "export_roundtrip": export_roundtrip,
    "distinct_devices": distinct_devices,
    "distinct_devices_merged": distinct_devices_merged,
    "distinct_devices_by_region_merged": distinct_devices_by_region_merged,
    "dashboard": dashboard,
    "dashboard_week": dashboard_week,
    "dashboard_empty": dashboard_empty,
    "fleet_rollup": fleet_rollup,
    "region_series": region_series,
    "latest_windows_top20": latest_windows_top20,
    "agg_row_count": agg_row_count,
    "device_history": device_history,
    "device_history_by_curve": device_history_by_curve,
    "device_windows": device_windows,
    "approx_percentile_check": approx_percentile_check,
    "kll_percentile_check": kll_percentile_check,
    "hll_distinct_check": hll_distinct_check,
    "cell_percentile_check": cell_percentile_check,
    "devices_missing_check": devices_missing_check,
    "window_1h_cells": window_1h_cells,
    "cells_rolled_up": cells_rolled_up,
}


def registered():
    """Name to (spark, sf_dir) -> DataFrame, each run with the session zone on UTC."""
    def under_utc(query):
        return lambda spark, sf_dir: query(pin_utc(spark), str(sf_dir).rstrip("/"))
    return {name: under_utc(query) for name, query in QUERIES.items()}
