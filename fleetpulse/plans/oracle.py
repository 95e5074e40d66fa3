"""The same results in DuckDB SQL over the test tables."""

from fleetpulse.plans.catalog import (
    AS_OF_MS, COPIES, DASHBOARD_LIMIT, DAY, DEVICE_COPIES, EMPTY_FROM_MS, EMPTY_TO_MS, HISTORY_DEVICE, HOUR, LIFE_DAYS, MINUTE,
    RETENTION_AS_OF_MS, WEEK_FROM_MS, WEEK_TO_MS,
)

HB = """hb AS (
  SELECT event_id, user_id, 'dev-' || CAST(user_id AS VARCHAR) AS device_id,
    CASE user_id % 4 WHEN 0 THEN 'us-east' WHEN 1 THEN 'us-west'
      WHEN 2 THEN 'eu-west' ELSE 'ap-south' END AS region,
    CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' ELSE 'ok' END AS status,
    epoch_us(ts) // 1000 AS timestamp_ms, value AS latency_ms,
    CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) / 100 AS cpu_usage,
    CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) / 100 AS mem_usage
  FROM events)"""

DOCUMENT = """'{"device_id":"' || device_id || '","region":"' || region || '","status":"' || status
  || '","timestamp_ms":' || timestamp_ms || ',"latency_ms":' || latency_ms
  || CASE WHEN cpu_usage = 0 THEN '' ELSE ',"cpu_usage":' || cpu_usage END
  || CASE WHEN mem_usage = 0 THEN '' ELSE ',"mem_usage":' || mem_usage END || '}'"""

FAULTY = HB + """, faulty AS (
  SELECT event_id,
    CASE event_id % 20 WHEN 0 THEN '  ' WHEN 1 THEN repeat('x', 129) WHEN 7 THEN repeat('x', 128)
      WHEN 9 THEN '' WHEN 10 THEN repeat('é', 65) ELSE device_id END AS device_id,
    CASE event_id % 20 WHEN 2 THEN '' ELSE region END AS region,
    CASE event_id % 20 WHEN 3 THEN 'asleep' ELSE status END AS status,
    CASE event_id % 20 WHEN 4 THEN 0 WHEN 5 THEN 1706745720001 WHEN 8 THEN 1706745720000
      ELSE timestamp_ms END AS timestamp_ms,
    CASE WHEN event_id % 20 IN (6, 9) THEN -0.25 ELSE latency_ms END AS latency_ms
  FROM hb), checked AS (
  SELECT *, CASE
    WHEN regexp_full_match(device_id, '[\\s\\p{Z}]*') THEN 'device_id is required'
    WHEN strlen(device_id) > 128 THEN 'device_id too long'
    WHEN regexp_full_match(region, '[\\s\\p{Z}]*') THEN 'region is required'
    WHEN status NOT IN ('ok', 'warn', 'error') THEN 'status must be one of ok|warn|error'
    WHEN timestamp_ms <= 0 THEN 'timestamp_ms must be positive'
    WHEN timestamp_ms > 1706745600000 + 120000
      THEN 'timestamp_ms is in the future beyond allowed skew'
    WHEN latency_ms < 0 THEN 'latency_ms must be non-negative' END AS reject_reason
  FROM faulty)"""

REQUESTS = HB + f""", sized AS (
  SELECT *, event_id % 10 AS c, event_id // 10 % 8 AS odd,
    CASE WHEN event_id % 80 IN (25, 75) THEN 1 WHEN event_id % 10 <= 2 THEN event_id % 5 + 1 WHEN event_id % 10 = 3 THEN 4
      WHEN event_id % 10 = 7 THEN 6 WHEN event_id % 10 IN (4, 5, 8) THEN 0 ELSE 1 END AS n
  FROM hb), outcomes AS (
  SELECT 'req-' || event_id AS request_id,
    CASE WHEN c IN (6, 8, 9) OR (c = 5 AND odd IN (1, 2, 4, 6, 7)) THEN 'single' ELSE 'batch' END AS kind,
    CAST(n AS INTEGER) AS n_events,
    CASE WHEN c = 8 THEN 'too_large' WHEN c = 5 AND odd = 2 THEN 'invalid'
      WHEN c = 5 AND odd = 3 THEN 'empty' WHEN c = 5 AND odd = 7 THEN 'accepted' WHEN c = 5 THEN 'bad_json' WHEN c = 4 THEN 'empty'
      WHEN c = 7 THEN 'batch_too_large' WHEN c IN (3, 9) THEN 'invalid' ELSE 'accepted' END AS outcome,
    CAST(CASE WHEN c = 3 THEN 2 WHEN c = 9 OR (c = 5 AND odd = 2) THEN 0 END AS INTEGER) AS first_bad_index,
    CASE WHEN c IN (3, 9) OR (c = 5 AND odd = 2) THEN 'device_id is required' END AS reason,
    CAST(CASE WHEN c = 5 AND odd = 2 THEN 422 WHEN c IN (7, 8) THEN 413 WHEN c = 5 AND odd = 7 THEN 202 WHEN c IN (4, 5) THEN 400 WHEN c IN (3, 9) THEN 422
      ELSE 202 END AS INTEGER) AS code, event_id
  FROM sized)"""

METRICS = ("avg_latency", "p50_latency", "p95_latency", "p99_latency")
ROUNDED = """round(avg_latency, 9) AS avg_latency, round(p50_latency, 6) AS p50_latency,
  round(p95_latency, 6) AS p95_latency, round(p99_latency, 6) AS p99_latency"""


def windows(seconds, rows="hb", dims="region, status", quantile="quantile_cont", name="win"):
    width = seconds * 1000
    return f"""{name} AS (
  SELECT timestamp_ms - timestamp_ms % {width} AS window_start_ms,
    timestamp_ms - timestamp_ms % {width} + {width} AS window_end_ms, {dims},
    count(*) AS count, count(DISTINCT device_id) AS distinct_count, avg(latency_ms) AS avg_latency,
    {quantile}(latency_ms, 0.5) AS p50_latency, {quantile}(latency_ms, 0.95) AS p95_latency,
    {quantile}(latency_ms, 0.99) AS p99_latency
  FROM {rows} GROUP BY ALL)"""


def window_rows(seconds, where="", dims="region, status", quantile="quantile_cont"):
    return f"""WITH {HB}, {windows(seconds, dims=dims, quantile=quantile)}
SELECT window_start_ms, window_end_ms, {dims}, count, distinct_count, {ROUNDED} FROM win {where}"""


CELL_FACTOR = 2.0 ** 43 + 1


def cell_points(keys, points, total="total"):
    """Percentile expressions over ``placed`` cells, grouped by ``keys``."""
    def at_rank(rank):
        return f"""max(CASE WHEN {rank} >= before AND {rank} < before + n THEN
          CASE WHEN {rank} - before = n - 1 THEN hi ELSE lo + ({rank} - before) * ((hi - lo) / greatest(n - 1, 1)) END END)"""

    def point(p):
        at = f"(CAST({p} AS DOUBLE) * ({total} - 1))"
        below, above, part = at_rank(f"floor{at}"), at_rank(f"ceil{at}"), f"max({at} - floor{at})"
        return f"CASE WHEN {below} = {above} THEN {below} ELSE {below} * (1 - {part}) + {above} * {part} END"
    return ", ".join(f"{point(p)} AS {name}" for name, p in points.items())


def placed_cells(rows, keys):
    """CTEs ``celled`` and ``placed``: value cells of ten leading bits with the rows before them."""
    return f"""celled AS (
  SELECT {keys}, latency_ms * {CELL_FACTOR} - (latency_ms * {CELL_FACTOR} - latency_ms) AS cell,
    count(*) AS n, min(latency_ms) AS lo, max(latency_ms) AS hi FROM {rows} GROUP BY ALL), placed AS (
  SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY cell) - n AS before,
    sum(n) OVER (PARTITION BY {keys}) AS total FROM celled)"""


POINTS = {"p50_latency": 0.5, "p95_latency": 0.95, "p99_latency": 0.99}


def cell_windows(seconds, rows="hb", where="", given=""):
    """Windows with percentiles of value cells, as streams write them."""
    width = seconds * 1000
    keys = "window_start_ms, region, status"
    return f"""WITH {HB}{given}, timed AS (
  SELECT *, timestamp_ms - timestamp_ms % {width} AS window_start_ms FROM {rows}), {placed_cells("timed", keys)},
points AS (SELECT {keys}, {cell_points(keys, POINTS)} FROM placed GROUP BY {keys}), counted AS (
  SELECT {keys}, window_start_ms + {width} AS window_end_ms, count(*) AS count,
    count(DISTINCT device_id) AS distinct_count, avg(latency_ms) AS avg_latency FROM timed GROUP BY {keys})
SELECT window_start_ms, window_end_ms, region, status, count, distinct_count, {ROUNDED}
FROM counted JOIN points USING ({keys}) {where}"""


def in_range(column, from_ms, to_ms):
    return f"{column} >= {from_ms} AND {column} < {to_ms}"


WEEK = in_range("window_start_ms", WEEK_FROM_MS, WEEK_TO_MS)
RAW_WEEK = in_range("timestamp_ms", WEEK_FROM_MS, WEEK_TO_MS)
MINUTES = f"WITH {HB}, {windows(MINUTE)}"
# windows a drained stream has closed: their end is at or before the watermark
CLOSED = "WHERE window_end_ms <= (SELECT max(timestamp_ms) FROM hb) - 30000"

RAW = """timestamp_ms AS event_time_ms, device_id, region, status, latency_ms,
  CAST(cpu_usage AS REAL) AS cpu_usage, CAST(mem_usage AS REAL) AS mem_usage,
  strftime(make_timestamp(timestamp_ms * 1000), '%Y%m%d') AS day"""

VERSIONS = f"""WITH {HB}, {windows(HOUR)}, versions AS (
  SELECT window_start_ms, window_end_ms, region, status, win.count + v AS count, distinct_count,
    {", ".join(METRICS)}, window_end_ms + 60000 + 1000 * least(v, 1) AS ingested_at_ms, v AS batch_id,
    strftime(make_timestamp(window_start_ms * 1000), '%Y%m%d') AS day
  FROM win, (SELECT unnest([0, 1, 2]) AS v) AS numbers
  WHERE v = 0 OR (v = 1 AND window_start_ms // 3600000 % 2 = 0)
    OR (v = 2 AND window_start_ms // 3600000 % 6 = 0)), newest AS (
  SELECT * FROM versions QUALIFY row_number() OVER (
    PARTITION BY window_start_ms, region, status ORDER BY ingested_at_ms DESC, batch_id DESC) = 1)"""
NEWEST = f"""{VERSIONS}
SELECT window_start_ms, window_end_ms, region, status, count, distinct_count, {ROUNDED},
  ingested_at_ms, batch_id, day FROM newest"""


def half_up(metric):
    return f"CAST(round(CAST({metric} AS DECIMAL(38, 9)), 1) AS DOUBLE)"


def series(where, limit=None, rows="win"):
    cut = f"ORDER BY window_start_ms, region, status LIMIT {limit}" if limit else ""
    return f"""series AS (SELECT * FROM {rows} WHERE {where} {cut})"""


def dashboard(from_ms, to_ms, limit=None, given=MINUTES, rows="win"):
    return f"""{given}, {series(in_range("window_start_ms", from_ms, to_ms), limit, rows)}
SELECT CAST(coalesce(sum(count), 0) AS BIGINT) AS total_events,
  round(coalesce(sum(avg_latency * count) / nullif(sum(count), 0), 0), 9) AS avg_latency_ms,
  round(coalesce(sum(p95_latency * count) / nullif(sum(count), 0), 0), 6) AS p95_latency_ms_weighted,
  round(coalesce(sum(p99_latency * count) / nullif(sum(count), 0), 0), 6) AS p99_latency_ms_weighted,
  (SELECT count(DISTINCT device_id) FROM hb WHERE {in_range("timestamp_ms", from_ms, to_ms)})
    AS distinct_devices, {"count(*) >= " + str(limit) if limit else "false"} AS truncated
FROM series"""


def nearest(p):
    rank = f"greatest(ceil(CAST({p} AS DOUBLE) * n) - 1, 0)"
    return f"max(latency_ms) FILTER (WHERE r = least({rank}, n - 1))"


def ranked(keys, rows="hb", given=""):
    return f"""WITH {HB}{given}, ranked AS (
  SELECT {keys}, latency_ms, row_number() OVER (PARTITION BY {keys} ORDER BY latency_ms) - 1 AS r,
    count(*) OVER (PARTITION BY {keys}) AS n FROM {rows})"""


MULTIPLIED = f"""multiplied AS (
  SELECT region, status, device_id || '-' || copy AS device_id, latency_ms * (1.0 + copy / 1000.0::DOUBLE) AS latency_ms
  FROM hb, range({COPIES}) AS copies(copy))"""


def exact_check(keys):
    return f"""{ranked(keys, "multiplied", f", {MULTIPLIED}")}
SELECT {keys}, round({nearest(0.5)}, 6) AS p50_latency, round({nearest(0.95)}, 6) AS p95_latency,
  round({nearest(0.99)}, 6) AS p99_latency, true AS within_tol FROM ranked GROUP BY {keys}"""


def rollup(rows):
    return f"""SELECT region, status, CAST(sum(count) AS BIGINT) AS events,
  max(distinct_count) AS peak_unique_devices, {half_up("avg(avg_latency)")} AS avg_ms,
  {half_up("avg(p95_latency)")} AS p95_ms, {half_up("avg(p99_latency)")} AS p99_ms
FROM {rows} GROUP BY region, status"""


DISTINCT_DEVICES = f"""WITH {HB}
SELECT count(DISTINCT device_id) AS distinct_devices FROM hb
WHERE {RAW_WEEK} AND status = 'warn'"""
RAW_ROWS = f"WITH {HB} SELECT {RAW} FROM hb"
STREAMED = cell_windows(HOUR, where=CLOSED)

ORACLES = {
    "decode_heartbeats": f"""WITH {HB}
SELECT event_id,
  CASE event_id % 10 WHEN 6 THEN '' ELSE device_id END AS device_id,
  CASE event_id % 10 WHEN 6 THEN '' ELSE region END AS region,
  CASE event_id % 10 WHEN 6 THEN '' ELSE status END AS status,
  CASE event_id % 10 WHEN 6 THEN 0 ELSE timestamp_ms END AS timestamp_ms,
  CASE event_id % 10 WHEN 6 THEN 0 ELSE latency_ms END AS latency_ms,
  CASE event_id % 10 WHEN 6 THEN 0 ELSE cpu_usage END AS cpu_usage,
  CASE event_id % 10 WHEN 6 THEN 0 ELSE mem_usage END AS mem_usage
FROM hb WHERE event_id % 10 >= 5""",
    "dead_letters": f"""WITH {HB}, docs AS (SELECT event_id, {DOCUMENT} AS value FROM hb)
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'not-json' WHEN 1 THEN 'null' WHEN 2 THEN ''
  WHEN 3 THEN '[' || value || ']'
  ELSE replace(value, '"latency_ms":', '"latency_ms":"abc","x":') END AS value
FROM docs WHERE event_id % 10 < 5""",
    "published_messages": f"WITH {HB} SELECT device_id AS key, {DOCUMENT} AS value FROM hb",
    "envelope_outcomes": f"""WITH {REQUESTS}
SELECT request_id, kind, n_events, outcome, first_bad_index, reason, code FROM outcomes""",
    "envelope_accepted_events": f"""WITH {REQUESTS}
SELECT 'req-' || event_id AS request_id, CAST(i AS INTEGER) AS position, device_id, region, status,
  timestamp_ms + i AS timestamp_ms, latency_ms, cpu_usage, mem_usage
FROM (SELECT *, unnest(range(n)) AS i FROM sized WHERE c IN (0, 1, 2, 6) OR (c = 5 AND odd = 7)) AS listed""",
    "ingest_counters": f"""WITH {REQUESTS}
SELECT count(*) AS requests_total,
  CAST(sum(CASE WHEN outcome = 'accepted' THEN n_events ELSE 0 END) AS BIGINT) AS accepted_total,
  CAST(sum(CASE outcome WHEN 'bad_json' THEN 1 WHEN 'invalid' THEN n_events ELSE 0 END) AS BIGINT)
    AS rejected_total
FROM outcomes""",
    "validate_accepted": f"""WITH {FAULTY}
SELECT event_id, device_id, region, status, timestamp_ms, latency_ms
FROM checked WHERE reject_reason IS NULL""",
    "validate_rejected": f"WITH {FAULTY} SELECT * FROM checked WHERE reject_reason IS NOT NULL",
    "reject_reason_counts": f"""WITH {FAULTY}
SELECT coalesce(reject_reason, '') AS reject_reason, count(*) AS events FROM checked GROUP BY 1""",
    "window_1m": window_rows(MINUTE),
    "window_1h": window_rows(HOUR),
    "window_1d": window_rows(DAY),
    "window_sparse": f"""WITH {HB}, lacking AS (
  SELECT region, status, CASE WHEN event_id % 10 = 0 THEN 0 ELSE latency_ms END AS latency_ms,
    CASE WHEN event_id % 10 = 1 THEN 0 ELSE timestamp_ms END AS timestamp_ms,
    CASE WHEN event_id % 10 = 2 THEN '' ELSE device_id END AS device_id FROM hb),
{windows(HOUR, "lacking")}
SELECT window_start_ms, window_end_ms, region, status, count, distinct_count, {ROUNDED} FROM win""",
    "window_by_extra_dim": f"""WITH {HB}, tagged AS (
  SELECT *, 'm' || CAST(user_id % 3 AS VARCHAR) AS device_model FROM hb),
{windows(DAY, "tagged", "region, status, device_model")}
SELECT window_start_ms, window_end_ms, region, status, device_model, count, distinct_count, {ROUNDED}
FROM win""",
    "nearest_rank_percentiles": f"""{ranked("region, status")}
SELECT region, status, min(latency_ms) AS p0, {nearest(0.5)} AS p50, {nearest(0.95)} AS p95,
  {nearest(0.99)} AS p99, max(latency_ms) AS p100 FROM ranked GROUP BY region, status""",
    "latency_percentiles_by_cells": f"""WITH {HB}
SELECT region, status, round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency,
  round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency
FROM hb GROUP BY region, status""",
    "stream_window_1h": STREAMED,
    "stream_raw_copy": RAW_ROWS,
    "stream_restart_no_duplicates": STREAMED,
    "stream_late_dropped": cell_windows(HOUR, "arrived", given=""", arrived AS (
  SELECT * FROM hb UNION ALL
  SELECT * FROM hb WHERE timestamp_ms - timestamp_ms % 3600000 + 3600000
    > (SELECT max(timestamp_ms) FROM hb) - 30000)"""),
    "repaired_windows": cell_windows(HOUR, "arrived", given=", arrived AS (SELECT * FROM hb UNION ALL SELECT * FROM hb)"),
    "stream_open_windows": cell_windows(HOUR, where=CLOSED.replace("<=", ">")),
    "stream_two_parts": cell_windows(HOUR),
    "raw_table_life": f"""WITH {HB}, life AS (
  SELECT * FROM hb WHERE timestamp_ms >= {WEEK_TO_MS - LIFE_DAYS * DAY * 1000}
  UNION ALL SELECT * FROM hb WHERE {in_range("timestamp_ms", WEEK_FROM_MS, WEEK_FROM_MS + 1000 * DAY)})
SELECT {RAW} FROM life""",
    "raw_table_rows": RAW_ROWS,
    "stored_raw_week": f"{RAW_ROWS} WHERE {RAW_WEEK}",
    "latest_versions": NEWEST,
    "compacted_rows": NEWEST,
    "compacted_incremental": NEWEST,
    "tags_added_later": f"""WITH {HB}, tagged AS (
  SELECT *, CASE WHEN timestamp_ms < {WEEK_FROM_MS} THEN '' ELSE 'm' || CAST(user_id % 3 AS VARCHAR) END AS device_model FROM hb),
{windows(DAY, "tagged", "region, status, device_model")}
SELECT window_start_ms, window_end_ms, region, status, device_model, count, distinct_count, {ROUNDED}
FROM win""",
    "devices_missing_check": f"""WITH {HB}, seen AS (
  SELECT region, device_id || '-' || event_id % {DEVICE_COPIES} AS device, bool_or(timestamp_ms < {WEEK_FROM_MS}) AS early,
    bool_or({RAW_WEEK}) AS week FROM hb GROUP BY ALL)
SELECT region, count(*) FILTER (early AND NOT week) AS missing, count(*) FILTER (early OR week) AS both,
  true AS within_tol FROM seen GROUP BY region""",
    "compacted_days": f"""{VERSIONS}
SELECT day, count(*) AS rows, CAST(sum(count) AS BIGINT) AS events,
  CAST(sum(batch_id) AS BIGINT) AS batches FROM newest GROUP BY day""",
    "retention_raw": f"""{RAW_ROWS}
WHERE timestamp_ms - timestamp_ms % 1000 + 604800000 > {AS_OF_MS}""",
    "retention_aggregates": window_rows(
        HOUR, f"WHERE window_start_ms + 7776000000 > {RETENTION_AS_OF_MS}"),
    "metrics_series": f"""{MINUTES}, {series(WEEK)}
SELECT window_start_ms, window_end_ms, region, status, count, distinct_count, {ROUNDED}
FROM series""",
    "metrics_series_filtered": f"""{MINUTES},
{series(WEEK + " AND region = 'us-east' AND status = 'ok'")}
SELECT window_start_ms, window_end_ms, region, status, count, distinct_count, {ROUNDED}
FROM series""",
    "distinct_devices_merged": DISTINCT_DEVICES,
    "distinct_devices_by_region_merged": f"""WITH {HB}
SELECT region, count(DISTINCT device_id) AS distinct_devices FROM hb GROUP BY region""",
    "distinct_devices": DISTINCT_DEVICES,
    "dashboard": dashboard(WEEK_FROM_MS, WEEK_TO_MS, DASHBOARD_LIMIT),
    "dashboard_week": dashboard(WEEK_FROM_MS, WEEK_TO_MS),
    "dashboard_empty": dashboard(EMPTY_FROM_MS, EMPTY_TO_MS),
    "stored_metrics": f"""{VERSIONS}, {series(WEEK, rows="newest")}
SELECT window_start_ms, window_end_ms, region, status, count, distinct_count, {ROUNDED}
FROM series""",
    "stored_dashboard": dashboard(WEEK_FROM_MS, WEEK_TO_MS, None, VERSIONS, "newest"),
    "stored_fleet_rollup": f"{VERSIONS} {rollup('newest')}",
    "sql_view_rollup": f"""{VERSIONS}
SELECT * FROM (SELECT region, status, CAST(sum(count) AS BIGINT) AS events,
    max(distinct_count) AS peak_unique_devices FROM newest WHERE {WEEK} GROUP BY region, status)
JOIN (SELECT region, status, count(DISTINCT device_id) AS devices
      FROM hb WHERE {RAW_WEEK} GROUP BY region, status) USING (region, status)""",
    "message_folder_read": f"""WITH {HB}
SELECT device_id, region, status, timestamp_ms, latency_ms, cpu_usage, mem_usage FROM hb""",
    "export_roundtrip": f"""WITH {HB}, {windows(HOUR)}
SELECT window_start_ms, region, status, count, round(p50_latency, 6) AS p50_latency, form
FROM win, (SELECT unnest(['json', 'csv', 'tsv', 'parquet']) AS form) AS forms""",
    "fleet_rollup": f"{MINUTES} {rollup('win')}",
    "region_series": f"""{MINUTES}
SELECT window_start_ms, region, CAST(sum(count) AS BIGINT) AS c, round(avg(p99_latency), 6) AS p99
FROM win GROUP BY window_start_ms, region""",
    "latest_windows_top20": f"""{MINUTES}
SELECT strftime(make_timestamp(window_start_ms * 1000), '%H:%M:%S') AS win, region, status, count,
  distinct_count, {half_up("avg_latency")} AS avg_ms, {half_up("p95_latency")} AS p95_ms,
  {half_up("p99_latency")} AS p99_ms
FROM win ORDER BY window_start_ms DESC, region, status LIMIT 20""",
    "agg_row_count": f"{VERSIONS} SELECT count(*) AS stored_rows FROM versions",
    "device_history": f"{RAW_ROWS} WHERE device_id = '{HISTORY_DEVICE}'",
    "device_history_by_curve": f"{RAW_ROWS} WHERE device_id = '{HISTORY_DEVICE}'",
    "device_windows": f"""WITH {HB}, {windows(HOUR)}
SELECT region, CAST(sum(distinct_count) AS BIGINT) AS device_windows FROM win GROUP BY region""",
    "approx_percentile_check": exact_check("region, status"),
    "kll_percentile_check": exact_check("region"),
    "hll_distinct_check": f"""WITH {HB}, {MULTIPLIED}
SELECT region, count(DISTINCT device_id) AS distinct_count, true AS within_tol
FROM multiplied GROUP BY region""",
    "cell_percentile_check": f"""SELECT * FROM ({exact_check("region")})
JOIN (SELECT CASE user_id % 4 WHEN 0 THEN 'us-east' WHEN 1 THEN 'us-west' WHEN 2 THEN 'eu-west' ELSE 'ap-south' END AS region,
  {COPIES} * count(*) AS count FROM events GROUP BY ALL) USING (region)""",
    "window_1h_cells": cell_windows(HOUR),
    "cells_rolled_up": f"""WITH {HB}, {placed_cells("hb", "region, status")}, points AS (
  SELECT region, status, {cell_points("region, status", POINTS)} FROM placed GROUP BY region, status)
SELECT region, status, count, {ROUNDED} FROM points JOIN (
  SELECT region, status, count(*) AS count, avg(latency_ms) AS avg_latency FROM hb GROUP BY ALL) USING (region, status)""",
}
