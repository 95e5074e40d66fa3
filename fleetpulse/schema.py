"""Row shapes and fixed limits, declared once for batch and streaming."""

from pyspark.sql import types as T

# The wire contract and its limits.
STATUSES = ("ok", "warn", "error")
DIMENSIONS = ("region", "status")
MAX_DEVICE_ID_BYTES = 128
MAX_BODY_BYTES = 1_048_576
MAX_BATCH_EVENTS = 1000
CLOCK_SKEW_MS = 120_000
WINDOW_SECONDS = 60
OUT_OF_ORDER_SECONDS = 30
MAX_QUERY_SPAN_MS = 604_800_000
AGGREGATE_RETENTION_DAYS = 90
RAW_RETENTION_DAYS = 7
PERCENTILES = {"p50_latency": 0.50, "p95_latency": 0.95, "p99_latency": 0.99}

HEARTBEAT = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("cpu_usage", T.DoubleType()),
    T.StructField("mem_usage", T.DoubleType()),
])
TEXT_FIELDS = ("device_id", "region", "status")
NUMBER_FIELDS = ("timestamp_ms", "latency_ms", "cpu_usage", "mem_usage")

ENVELOPE = T.StructType([T.StructField("heartbeats", T.ArrayType(HEARTBEAT))])


def with_tags(shape, tags=(), after="status"):
    """A row shape with extra text dimensions, such as a device model, behind ``after``."""
    fields = list(shape.fields)
    at = shape.fieldNames().index(after) + 1
    fields[at:at] = [T.StructField(tag, T.StringType()) for tag in tags]
    return T.StructType(fields)


def extra_tags(dims):
    return tuple(d for d in dims if d not in DIMENSIONS)


REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("body", T.StringType()),
])

RAW_TABLE = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("cpu_usage", T.FloatType()),
    T.StructField("mem_usage", T.FloatType()),
    T.StructField("day", T.StringType()),
])
RAW_ORDER = ("event_time", "region", "device_id")

AGGREGATE_TABLE = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("region", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("distinct_count", T.LongType()),
    T.StructField("avg_latency", T.DoubleType()),
    T.StructField("p50_latency", T.DoubleType()),
    T.StructField("p95_latency", T.DoubleType()),
    T.StructField("p99_latency", T.DoubleType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("day", T.StringType()),
])
AGGREGATE_KEY = ("window_start", "region", "status")
AGGREGATE_VERSION = ("ingested_at", "batch_id")

# First and last millisecond of the years 1 to 9999.
TIMESTAMP_MS = (-62_135_596_800_000, 253_402_300_799_999)
