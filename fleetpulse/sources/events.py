"""The ``events`` test table as heartbeats, faulty heartbeats, messages, requests and versions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse import schema
from fleetpulse.operators.decode import encode_heartbeats
from fleetpulse.sources.scans import parquet_stream

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# The check time of the faulty rows (2024-02-01 UTC) and the small caps of the requests.
AS_OF_MS = 1_706_745_600_000
SMALL_BATCH = 5
SMALL_BODY = 2000


def _between(events, from_ms, to_ms):
    """Time bounds on the stored column, so that they reach the scan."""
    for bound, keep in ((from_ms, F.col("ts").__ge__), (to_ms, F.col("ts").__lt__)):
        if bound is not None:
            events = events.where(keep(
                F.timestamp_millis(F.lit(bound)).cast("timestamp_ntz")))
    return events


def _as_heartbeats(events, keep=("event_id",)):
    user = F.col("user_id")
    reading = F.regexp_extract("props", r"\d+", 0).cast("double") / 100
    return events.select(
        *keep,
        F.concat(F.lit("dev-"), user.cast("string")).alias("device_id"),
        F.when(user % 4 == 0, "us-east").when(user % 4 == 1, "us-west")
        .when(user % 4 == 2, "eu-west").otherwise("ap-south").alias("region"),
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "signup", "warn").otherwise("ok").alias("status"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.col("value").alias("latency_ms"),
        reading.alias("cpu_usage"), reading.alias("mem_usage"),
    )


def heartbeats(spark, sf_dir, from_ms=None, to_ms=None, keep=("event_id",)):
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return _as_heartbeats(_between(events, from_ms, to_ms), keep)


def heartbeat_stream(spark, sf_dir):
    return _as_heartbeats(parquet_stream(spark, f"{sf_dir}/events.parquet", EVENTS))


def message_stream(spark, sf_dir):
    """The table as a stream of JSON messages, as a topic would deliver it."""
    return heartbeat_stream(spark, sf_dir).select(*encode_heartbeats())


def faulty_heartbeats(beats):
    """Every rule broken by a twentieth of the rows, the rest left valid."""
    case = F.col("event_id") % 20
    return beats.select(
        "event_id",
        F.when(case == 0, "  ").when(case == 1, "x" * 129).when(case == 7, "x" * 128)
        .when(case == 9, "").when(case == 10, "é" * 65)
        .otherwise(F.col("device_id")).alias("device_id"),
        F.when(case == 2, "").otherwise(F.col("region")).alias("region"),
        F.when(case == 3, "asleep").otherwise(F.col("status")).alias("status"),
        F.when(case == 4, 0).when(case == 5, AS_OF_MS + 120_001)
        .when(case == 8, AS_OF_MS + 120_000)
        .otherwise(F.col("timestamp_ms")).alias("timestamp_ms"),
        F.when(case.isin(6, 9), -0.25).otherwise(F.col("latency_ms")).alias("latency_ms"),
    )


def faulty_messages(beats):
    """(event_id, value): a tenth each of unreadable, mistyped, null, empty and list bodies."""
    _, document = encode_heartbeats()
    good = beats.select("event_id", document)
    case = F.col("event_id") % 10
    return good.select("event_id", (
        F.when(case == 0, "not-json").when(case == 1, "null").when(case == 2, "")
        .when(case == 3, F.concat(F.lit("["), F.col("value"), F.lit("]")))
        .when(case == 4, F.regexp_replace("value", r'"latency_ms":', '"latency_ms":"abc","x":'))
        .when(case == 5, F.regexp_replace("value", r"^\{", '{"extra":{"a":[1]},'))
        .when(case == 6, "{}")
        .otherwise(F.col("value"))).alias("value"))


def requests(beats):
    """One request per event, its body built inside the row.

    By event_id % 10: 0-2 list of one to five events; 3 list with one bad event at
    index 2; 4 empty list; 5 not one document; 6 single; 7 six events, over the small
    batch cap; 8 body over the small size cap; 9 single without a device.

    Those of 5 by the next digits modulo 8: 0 unreadable; 1 two events, 2 null, 4 an event with
    text after it, 6 one with a number as device and 7 one with keys in capitals as single; 3 null and
    5 two lists as batch.
    """
    case, odd = F.col("event_id") % 10, F.floor(F.col("event_id") / 10) % 8
    fields = schema.HEARTBEAT.fieldNames()
    size = (F.when(case <= 2, F.col("event_id") % 5 + 1).when(case == 3, 4)
            .when(case == 7, 6).otherwise(1)).cast("int")

    def copy(i):
        device = F.when((case == 9) | ((case == 3) & (i == 2)), "").otherwise(F.col("device_id"))
        shifted = F.col("timestamp_ms") + i
        return F.struct(*[{"device_id": device, "timestamp_ms": shifted}.get(c, F.col(c)).alias(c)
                          for c in fields])

    copies = F.transform(F.sequence(F.lit(0), size - 1), copy)
    listed = F.to_json(F.struct(copies.alias("heartbeats")))
    body = (
        F.when(case == 4, '{"heartbeats":[]}')
        .when((case == 5) & (odd == 0), "{not json")
        .when((case == 5) & (odd == 1), F.concat(F.to_json(copies[0]), F.to_json(copies[0])))
        .when((case == 5) & odd.isin(2, 3), "null")
        .when((case == 5) & (odd == 4), F.concat(F.to_json(copies[0]), F.lit(" {")))
        .when((case == 5) & (odd == 5), F.concat(listed, F.lit("\n"), listed))
        .when((case == 5) & (odd == 6), F.regexp_replace(F.to_json(copies[0]), '"dev-([0-9]+)"', "$1"))
        .when((case == 5) & (odd == 7), F.regexp_replace(
            F.regexp_replace(F.to_json(copies[0]), "device_id", "DEVICE_ID"), "timestamp_ms", "Timestamp_MS"))
        .when(case.isin(6, 9), F.to_json(copies[0]))
        .when(case == 8, F.concat(F.to_json(copies[0]), F.lit(" " * SMALL_BODY)))
        .otherwise(listed)
    )
    return beats.select(
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.when(case.isin(6, 8, 9) | ((case == 5) & odd.isin(1, 2, 4, 6, 7)), "single").otherwise("batch").alias("kind"),
        body.alias("body"))


def aggregate_versions(windows):
    """First versions of all windows; a second a second later for those of even hours;
    for every sixth hour a third of the same second in a later batch."""
    hour = F.floor(F.unix_seconds("window_start") / 3600)
    first_ms = F.unix_millis("window_end") + 60_000

    copies = F.explode(F.array_compact(F.array(
        F.lit(0), F.when(hour % 2 == 0, 1), F.when(hour % 6 == 0, 2)))).alias("copy")
    numbered = windows.select("*", copies)
    nth = F.col("copy")
    return numbered.select(
        *[c for c in windows.columns if c != "count"],
        (F.col("count") + nth).alias("count"),
        F.timestamp_millis(first_ms + F.least(nth, F.lit(1)) * 1000).alias("ingested_at"),
        nth.cast("long").alias("batch_id"))
