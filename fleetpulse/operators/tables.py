"""Shapes, layout, versions and retention of the two stored tables."""

from decimal import Decimal

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import day_key, event_time, narrow, number_or_zero, text_or_empty, whole_second

# Micro-batch numbers that fit beside the second in one long: 17 years of one per second.
BATCH_IDS = Decimal(2 ** 64)


def raw_rows(heartbeats, tags=()):
    """Heartbeats as rows of the raw table."""
    at = event_time(F.col("timestamp_ms"))
    return heartbeats.select(
        at.alias("event_time"),
        *[text_or_empty(F.col(c)).alias(c) for c in (*schema.TEXT_FIELDS, *tags)],
        number_or_zero(F.col("latency_ms")).cast("double").alias("latency_ms"),
        narrow(F.col("cpu_usage")).alias("cpu_usage"),
        narrow(F.col("mem_usage")).alias("mem_usage"),
        day_key(at).alias("day"),
    )


def aggregate_rows(windows, batch_id=0, ingested_at=None):
    """Window results as versioned rows; the insert time has whole seconds."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return windows.select(
        "*", whole_second(stamp).alias("ingested_at"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        day_key(F.col("window_start")).alias("day"),
    )


def in_time_range(table, column, from_ms, to_ms):
    """Half-open range on a timestamp; a ``day`` column narrows the folders to read."""
    rows = table.where((F.col(column) >= F.timestamp_millis(F.lit(from_ms)))
                       & (F.col(column) < F.timestamp_millis(F.lit(to_ms))))
    if "day" not in table.columns:
        return rows
    return rows.where(F.col("day").between(
        day_key(F.timestamp_millis(F.lit(from_ms))), day_key(F.timestamp_millis(F.lit(to_ms - 1)))))


def _version():
    """Insert second and batch as one number, so that the newest is found by hash aggregation.

    An absent batch counts as 0; any other long keeps its order.
    """
    seconds = F.unix_seconds("ingested_at").cast("decimal(18,0)")
    return seconds * F.lit(BATCH_IDS) + F.coalesce("batch_id", F.lit(0)).cast("decimal(20,0)")


def latest_version(aggregates, key=schema.AGGREGATE_KEY):
    """One row per key: the newest insert, the higher batch on equal seconds.

    The maximum is folded before the shuffle, so many copies of one key travel
    as one row per map task, and columns nobody asks for are not read. The day
    follows from the window start and stays a grouping column.
    """
    fixed = [c for c in aggregates.columns if c in key or c == "day"]
    newest = [F.max_by(c, _version()).alias(c) for c in aggregates.columns if c not in fixed]
    return aggregates.groupBy(*fixed).agg(*newest).select(*aggregates.columns)


def unexpired(table, column, as_of_ms, keep_days):
    """Rows whose second plus the keeping time is still ahead of ``as_of_ms``."""
    now = F.timestamp_millis(F.lit(as_of_ms))
    kept = table.where(
        whole_second(F.col(column)) + F.make_dt_interval(F.lit(keep_days)) > now)
    # the same bound on the bare column reaches the parquet scan
    oldest_ms = as_of_ms - keep_days * 86_400_000
    kept = kept.where(F.col(column) >= F.timestamp_millis(F.lit(oldest_ms)))
    if "day" not in table.columns:
        return kept
    return kept.where(F.col("day") >= day_key(F.timestamp_millis(F.lit(oldest_ms))))


def unexpired_raw(table, as_of_ms, keep_days=schema.RAW_RETENTION_DAYS):
    return unexpired(table, "event_time", as_of_ms, keep_days)


def unexpired_aggregates(table, as_of_ms, keep_days=schema.AGGREGATE_RETENTION_DAYS):
    return unexpired(table, "window_start", as_of_ms, keep_days)


def lay_out_by_day(rows, order, in_time_order=False):
    """Range-split by day and sort columns, sorted inside each task.

    Files then cover disjoint time ranges and a day of any size spans as many
    tasks as it needs. The input partition number as last range column splits
    a run of equal rows too; adaptive execution merges small ranges. Input whose
    partitions follow time already is sorted where it is, without a shuffle.
    """
    if in_time_order:
        return rows.sortWithinPartitions("day", *order)
    tagged = rows.withColumn("_origin", F.spark_partition_id())
    spread = tagged.repartitionByRange("day", *order, "_origin")
    return spread.sortWithinPartitions("day", *order).drop("_origin")


def lay_out_closed_windows(rows, key):
    """Spread the windows a micro-batch closed by hour, sorted inside each task.

    A hash exchange runs the stateful plan below it once, where a range split
    would run it again to sample. An hour holds few windows per dimension value.
    """
    hour = F.date_trunc("hour", "window_start")
    return rows.repartition("day", hour).sortWithinPartitions("day", *key)
