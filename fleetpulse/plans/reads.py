"""The read queries over the two tables, as DataFrames."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import clock_text, epoch_ms, round_half_up
from fleetpulse.operators.tables import in_time_range, latest_version


# The answers to wrong arguments.
RANGE_REQUIRED = "from and to (unix ms) are required"
RANGE_BACKWARDS = "to must be greater than from"
FROM_NOT_POSITIVE = "from must be positive"
RANGE_TOO_LONG = "query window exceeds max of %g days"
DEVICE_UNSUPPORTED = "device_id filter is not supported; use device_history"
LIMIT_NOT_POSITIVE = "invalid limit: must be positive"
STATUS_UNKNOWN = "status must be one of ok|warn|error"
NOT_A_NUMBER = "invalid %s: %r"


def _whole_number(name, value):
    try:
        return int(value)
    except (TypeError, ValueError):
        raise ValueError(NOT_A_NUMBER % (name, value)) from None


def _demand(holds, message):
    if not holds:
        raise ValueError(message)


@dataclass(frozen=True)
class ReadFilter:
    """Checked arguments of the series, distinct and dashboard queries."""

    from_ms: int
    to_ms: int
    region: str = ""
    status: str = ""
    limit: int | None = None
    tags: tuple = ()

    @classmethod
    def of(cls, from_ms=None, to_ms=None, region="", status="", limit=None, device_id=None,
           max_span_ms=schema.MAX_QUERY_SPAN_MS, **tags):
        """Checked arguments; a range longer than ``max_span_ms`` is refused, never cut."""
        _demand(from_ms not in (None, "") and to_ms not in (None, ""), RANGE_REQUIRED)
        start, end = _whole_number("from", from_ms), _whole_number("to", to_ms)
        _demand(end > start, RANGE_BACKWARDS)
        _demand(start > 0, FROM_NOT_POSITIVE)
        _demand(end - start <= max_span_ms, RANGE_TOO_LONG % (max_span_ms / 86_400_000))
        _demand(not device_id, DEVICE_UNSUPPORTED)
        rows = None if limit in (None, "") else _whole_number("limit", limit)
        _demand(rows is None or rows > 0, LIMIT_NOT_POSITIVE)
        _demand(not status or status in schema.STATUSES, STATUS_UNKNOWN)
        return cls(start, end, region or "", status or "", rows, tuple(tags.items()))


# The aggregate columns that are not dimensions.
MEASURES = ("window_end", "count", "distinct_count", "avg_latency", *schema.PERCENTILES,
            *schema.AGGREGATE_VERSION, "day")


def current(aggregates, collapse=True):
    """Newest version per window and dimensions, where the rows carry versions."""
    if collapse and set(schema.AGGREGATE_VERSION) <= set(aggregates.columns):
        return latest_version(aggregates, [c for c in aggregates.columns if c not in MEASURES])
    return aggregates


def _tags(aggregates):
    return [c for c in aggregates.columns
            if c not in MEASURES and c not in schema.AGGREGATE_KEY]


def _matching(table, column, wanted):
    rows = in_time_range(table, column, wanted.from_ms, wanted.to_ms)
    for name, value in (("region", wanted.region), ("status", wanted.status), *wanted.tags):
        if value:
            rows = rows.where(F.col(name) == value)
    return rows


def metrics_series(aggregates, wanted, collapse=True):
    """Windows in time order, times as epoch ms; all of them unless a limit is given."""
    rows = current(_matching(aggregates, "window_start", wanted), collapse)
    tags = _tags(aggregates)
    ordered = rows.orderBy("window_start", "region", "status", *tags)
    if wanted.limit is not None:
        ordered = ordered.limit(wanted.limit)
    return ordered.select(
        epoch_ms("window_start").alias("window_start_ms"),
        epoch_ms("window_end").alias("window_end_ms"),
        "region", "status", *tags, "count", "distinct_count",
        "avg_latency", *schema.PERCENTILES)


def distinct_devices(raw, wanted):
    """Exact distinct devices of a range; the series limit plays no part."""
    return _matching(raw, "event_time", wanted).agg(
        F.count_distinct("device_id").alias("distinct_devices"))


def weighted(metric, weight="count"):
    """Mean weighted by event count, 0 when there are no events."""
    total = F.sum(weight)
    return F.coalesce(F.sum(F.col(metric) * F.col(weight)) / F.nullif(total, F.lit(0)), F.lit(0.0))


def _totals():
    return (F.coalesce(F.sum("count"), F.lit(0)).alias("total_events"),
            weighted("avg_latency").alias("avg_latency_ms"),
            weighted("p95_latency").alias("p95_latency_ms_weighted"),
            weighted("p99_latency").alias("p99_latency_ms_weighted"))


def roll_up(series):
    return series.agg(*_totals())


def dashboard(aggregates, raw, wanted, collapse=True, totals_of_series=False):
    """(summary, series): totals and distinct devices of the whole range, and the series.

    ``totals_of_series`` takes the totals over the limited series instead. ``truncated``
    says whether the limit left windows out of the series.
    """
    series = metrics_series(aggregates, wanted, collapse)
    rows = current(_matching(aggregates, "window_start", wanted), collapse)
    limit = F.lit(wanted.limit).cast("long")
    counted = rows.agg(F.coalesce(F.count("*") > limit, F.lit(False)).alias("truncated"))
    summary = roll_up(series if totals_of_series else rows)
    return summary.withColumn("distinct_devices", distinct_devices(raw, wanted).scalar()).withColumn(
        "truncated", counted.scalar()), series


def _since(aggregates, as_of_ms, minutes):
    """Windows that start after the look-back point, newest first by choice of caller."""
    edge_ms = as_of_ms - minutes * 60_000
    rows = aggregates.where(F.col("window_start") > F.timestamp_millis(F.lit(edge_ms)))
    if "day" in aggregates.columns:
        rows = in_time_range(rows, "window_start", edge_ms, 253_402_300_800_000)
    return rows


def _listed(series):
    """The series as one array in time order; the limit of the filter caps its length."""
    return F.array_sort(F.collect_list(F.struct(*series.columns))).alias("series")


def _echo(wanted):
    fields = {"from_ms": wanted.from_ms, "to_ms": wanted.to_ms, "region": wanted.region,
              "status": wanted.status, "limit": wanted.limit, **dict(wanted.tags)}
    return F.struct(*[F.lit(v).alias(k) for k, v in fields.items()])


def _demand_limit(wanted):
    if wanted.limit is None:
        raise ValueError("a document gathers its series into one row: give a limit")


def metrics_document(aggregates, wanted, collapse=True):
    """The series answer as one row: filter, count and series, which needs a limit."""
    _demand_limit(wanted)
    series = metrics_series(aggregates, wanted, collapse)
    answer = series.agg(F.count("*").alias("count"), _listed(series))
    return answer.select(_echo(wanted).alias("filter"), "count", "series")


def distinct_document(raw, wanted):
    return distinct_devices(raw, wanted).select(_echo(wanted).alias("filter"), "distinct_devices")


def dashboard_document(aggregates, raw, wanted, collapse=True):
    """The dashboard answer of a limited series as one row with the series inside."""
    _demand_limit(wanted)
    series = metrics_series(aggregates, wanted, collapse)
    return series.agg(*_totals(), _listed(series)).select(
        _echo(wanted).alias("filter"), "total_events",
        distinct_devices(raw, wanted).scalar().alias("distinct_devices"), "avg_latency_ms",
        "p95_latency_ms_weighted", "p99_latency_ms_weighted", "series")


def register_views(aggregates, raw):
    """Views for SQL text: ``heartbeats``, ``heartbeat_aggregates`` with the newest version
    of each window, ``heartbeat_aggregates_stored`` with all versions as stored.

    A time bound on a view opens every day. The table functions ``heartbeats_between`` and
    ``windows_between`` of (from_ms, to_ms) read the days of their half-open range only.
    """
    raw.createOrReplaceTempView("heartbeats")
    current(aggregates).createOrReplaceTempView("heartbeat_aggregates")
    aggregates.createOrReplaceTempView("heartbeat_aggregates_stored")
    for name, view, at, shape in (("heartbeats_between", "heartbeats", "event_time", raw),
                                  ("windows_between", "heartbeat_aggregates", "window_start", aggregates)):
        days = """AND day BETWEEN date_format(timestamp_millis(from_ms), 'yyyyMMdd')
            AND date_format(timestamp_millis(to_ms - 1), 'yyyyMMdd')""" if "day" in shape.columns else ""
        raw.sparkSession.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(from_ms BIGINT, to_ms BIGINT)
            RETURNS TABLE ({", ".join(f"{c} {kind}" for c, kind in shape.dtypes)})
            RETURN SELECT {", ".join(shape.columns)} FROM {view}
            WHERE {at} >= timestamp_millis(from_ms) AND {at} < timestamp_millis(to_ms) {days}""")


def fleet_rollup(aggregates, as_of_ms, minutes=30, collapse=True):
    """Per region and status: events, peak devices, plain means of the window metrics."""
    rows = current(_since(aggregates, as_of_ms, minutes), collapse)
    return (rows.groupBy("region", "status").agg(
        F.sum("count").alias("events"),
        F.max("distinct_count").alias("peak_unique_devices"),
        round_half_up(F.avg("avg_latency")).alias("avg_ms"),
        round_half_up(F.avg("p95_latency")).alias("p95_ms"),
        round_half_up(F.avg("p99_latency")).alias("p99_ms"),
    ).orderBy(F.desc("events"), "region", "status"))


def region_series(aggregates, as_of_ms, minutes=60, collapse=True):
    """One point per window and region for charting."""
    rows = current(_since(aggregates, as_of_ms, minutes), collapse)
    return (rows.groupBy("window_start", "region")
            .agg(F.sum("count").alias("c"), F.avg("p99_latency").alias("p99"))
            .orderBy("window_start", "region"))


def latest_windows(aggregates, as_of_ms, minutes=10, rows=20, collapse=True):
    """The newest windows with display rounding."""
    found = current(_since(aggregates, as_of_ms, minutes), collapse)
    newest = found.orderBy(F.desc("window_start"), "region", "status").limit(rows)
    return newest.select(
        clock_text("window_start").alias("win"), "region", "status", "count", "distinct_count",
        round_half_up(F.col("avg_latency")).alias("avg_ms"),
        round_half_up(F.col("p95_latency")).alias("p95_ms"),
        round_half_up(F.col("p99_latency")).alias("p99_ms"))


def stored_rows(aggregates):
    """Row count as stored, versions included."""
    return aggregates.agg(F.count("*").alias("stored_rows"))


def device_history(raw, device_id, from_ms, to_ms):
    """The raw heartbeats of one device in a range, in time order."""
    rows = in_time_range(raw, "event_time", from_ms, to_ms).where(F.col("device_id") == device_id)
    return rows.orderBy("event_time", *[c for c in rows.columns if c != "event_time"])


def device_windows(aggregates, from_ms, to_ms, by=(), collapse=True):
    """Sum of per-window distincts over a long range; a device counts once per window."""
    rows = current(in_time_range(aggregates, "window_start", from_ms, to_ms), collapse)
    return rows.groupBy(*by).agg(F.coalesce(F.sum("distinct_count"), F.lit(0)).alias("device_windows"))
