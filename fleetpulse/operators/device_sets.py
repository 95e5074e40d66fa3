"""Exact sets of devices that merge: a dictionary of dense numbers and bitmaps per window.

Each device gets a number once. A window stores its devices as bitmaps of 32,768 numbers each, so that the exact
distinct count of any range is an OR of stored rows and needs neither the raw table nor its retention. The
number of bitmaps per window grows with the devices known, not with the events.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import text_or_empty
from fleetpulse.operators.windows import with_event_time
from fleetpulse.session import saved


def _numbered(devices, first):
    """Gapless numbers from ``first`` on: the place in the task plus the counts of the tasks before it."""
    placed = saved(devices.select("device_id", F.monotonically_increasing_id().alias("place")), "device-places")
    task, row = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    # one row per task
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.withColumn("task", task).join(F.broadcast(starts), "task").select(
        "device_id", (F.lit(first) + F.col("start") + row).alias("number"))


def device_dictionary(heartbeats, known=None):
    """device_id and number of every device; those in ``known`` keep theirs, new ones get the next."""
    seen = heartbeats.select(text_or_empty(F.col("device_id")).alias("device_id")).distinct()
    if known is None:
        return _numbered(seen, 0)
    first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    fresh = seen.join(known.select("device_id"), "device_id", "left_anti")
    return known.select("device_id", "number").unionByName(_numbered(fresh, first))


def device_sets(heartbeats, dictionary, seconds=schema.WINDOW_SECONDS, dims=schema.DIMENSIONS):
    """A row per window, dimensions and block of numbers, with the bitmap of the devices seen.

    Events are folded to one row per window and device before the dictionary is joined, so a hot
    device travels once per window.
    """
    timed = heartbeats if "event_time" in heartbeats.columns else with_event_time(heartbeats)
    seen = timed.select(
        F.window("event_time", f"{seconds} seconds")["start"].alias("window_start"),
        *[text_or_empty(F.col(d)).alias(d) for d in dims],
        text_or_empty(F.col("device_id")).alias("device_id")).distinct()
    number = F.col("number")
    return seen.join(dictionary, "device_id").groupBy(
        "window_start", *dims, F.bitmap_bucket_number(number).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("devices"))


def merged_distinct(sets, keys=()):
    """Exact distinct devices of all stored windows given, per ``keys``: always one row without keys."""
    merged = sets.groupBy(*keys, "block").agg(F.bitmap_or_agg("devices").alias("devices"))
    counted = F.coalesce(F.sum(F.bitmap_count("devices")), F.lit(0)).cast("long").alias("distinct_devices")
    return merged.groupBy(*keys).agg(counted)
