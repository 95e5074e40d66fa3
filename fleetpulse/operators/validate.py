"""Row validation: the first broken rule names the reason."""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import blank_text, byte_length, number_or_zero, text_or_empty

# The reason texts of the wire contract.
DEVICE_REQUIRED = "device_id is required"
DEVICE_TOO_LONG = "device_id too long"
REGION_REQUIRED = "region is required"
STATUS_UNKNOWN = "status must be one of ok|warn|error"
TIMESTAMP_NOT_POSITIVE = "timestamp_ms must be positive"
TIMESTAMP_IN_FUTURE = "timestamp_ms is in the future beyond allowed skew"
LATENCY_NEGATIVE = "latency_ms must be non-negative"


def valid_status(status):
    return text_or_empty(status).isin(*schema.STATUSES)


def reject_reason(now_ms, skew_ms=schema.CLOCK_SKEW_MS, row=F.col):
    """Reason text or null. ``row`` reaches a field: a column, or a struct's field."""
    device, sent_at = row("device_id"), number_or_zero(row("timestamp_ms"))
    latency = number_or_zero(row("latency_ms"))
    return (
        F.when(blank_text(device), DEVICE_REQUIRED)
        .when(byte_length(device) > schema.MAX_DEVICE_ID_BYTES, DEVICE_TOO_LONG)
        .when(blank_text(row("region")), REGION_REQUIRED)
        .when(~valid_status(row("status")), STATUS_UNKNOWN)
        .when(sent_at <= 0, TIMESTAMP_NOT_POSITIVE)
        .when(sent_at > F.lit(now_ms + skew_ms), TIMESTAMP_IN_FUTURE)
        .when((latency < 0) | F.isnan(latency), LATENCY_NEGATIVE)
    )


def with_reject_reason(heartbeats, now_ms, skew_ms=schema.CLOCK_SKEW_MS):
    return heartbeats.withColumn("reject_reason", reject_reason(now_ms, skew_ms))


def accepted(heartbeats, now_ms, skew_ms=schema.CLOCK_SKEW_MS):
    return heartbeats.where(reject_reason(now_ms, skew_ms).isNull())


def quarantined(heartbeats, now_ms, skew_ms=schema.CLOCK_SKEW_MS):
    checked = with_reject_reason(heartbeats, now_ms, skew_ms)
    return checked.where(F.col("reject_reason").isNotNull())


def reason_counts(heartbeats, now_ms, skew_ms=schema.CLOCK_SKEW_MS):
    """Rows per outcome; accepted rows count under an empty reason."""
    checked = with_reject_reason(heartbeats, now_ms, skew_ms)
    return (checked.groupBy(text_or_empty(F.col("reject_reason")).alias("reject_reason"))
            .agg(F.count("*").alias("events")))
