"""Repair of closed windows: the raw table keeps late rows, which the windows have lost."""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators.tables import day_key, in_time_range, latest_version
from fleetpulse.operators.windows import window_aggregate
from fleetpulse.session import saved
from fleetpulse.sinks import stores


def counted_windows(raw, seconds, dims):
    """Windows of the raw table by number of rows alone: two columns more than the dimensions are read."""
    return raw.groupBy(F.window("event_time", f"{seconds} seconds")["start"].alias("window_start"), *dims).agg(
        F.count("*").alias("raw_count"))


def differing_windows(stored, raw, from_ms, to_ms, seconds=schema.WINDOW_SECONDS, dims=schema.DIMENSIONS):
    """Windows that start in the range and whose newest stored count is not that of the raw table.

    Keys, ``stored_count``, ``raw_count`` (null where a side lacks the window) and day. Choose a range that
    the raw table still holds, up to windows that the stream has closed.
    """
    key = ["window_start", *dims]
    newest = latest_version(in_time_range(stored, "window_start", from_ms, to_ms), key)
    rows = in_time_range(raw, "event_time", from_ms, to_ms + 1000 * seconds)
    counts = in_time_range(counted_windows(rows, seconds, dims), "window_start", from_ms, to_ms)
    both = newest.select(*key, F.col("count").alias("stored_count")).join(counts, key, "full_outer")
    differ = both.where(~F.col("stored_count").eqNullSafe(F.col("raw_count")))
    return differ.withColumn("day", day_key(F.col("window_start")))


def repaired(raw, differing, seconds=schema.WINDOW_SECONDS, dims=schema.DIMENSIONS):
    """The differing windows as the raw table has them; only the days that differ are read.

    A stored window of which the raw table has no row at all is left as it is.
    """
    day_seconds = 86_400
    first = F.floor(F.unix_seconds("window_start") / day_seconds)
    last = F.floor((F.unix_seconds("window_start") + F.lit(seconds - 1)) / day_seconds)
    touched = differing.select(F.explode(F.sequence(first, last)).alias("n")).distinct()
    days = [r.day for r in touched.select(day_key(F.timestamp_seconds(F.col("n") * day_seconds)).alias("day")).collect()]
    windows = window_aggregate(raw.where(F.col("day").isin(days)), seconds, dims, quantiles="cells")
    return windows.join(differing.select("window_start", *dims), ["window_start", *dims], "left_semi")


def repair_windows(spark, path, stored, raw, from_ms, to_ms, seconds=schema.WINDOW_SECONDS,
                   dims=schema.DIMENSIONS, batch_id=0):
    """Append new versions of the windows that differ; readers take them as the newest. Gives the differences.

    Run again it finds nothing to do. Percentiles are those of the stream.
    """
    differing = saved(differing_windows(stored, raw, from_ms, to_ms, seconds, dims), "differing-windows")
    stores.append_aggregates(repaired(raw, differing, seconds, dims), path, batch_id, key=("window_start", *dims))
    return differing
