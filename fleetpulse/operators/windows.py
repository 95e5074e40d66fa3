"""Tumbling event-time windows by dimension: one definition for batch and stream."""

from functools import reduce

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import event_time, number_or_zero, text_or_empty
from fleetpulse.operators import cells, sketches
from fleetpulse.operators.percentiles import percentiles_by_key
from fleetpulse.session import saved

APPROX_ACCURACY = 10_000


def with_event_time(heartbeats):
    return heartbeats.withColumn("event_time", event_time(number_or_zero(F.col("timestamp_ms"))))


def with_watermark(heartbeats, out_of_order_seconds=schema.OUT_OF_ORDER_SECONDS):
    """Event time plus the bound by which an event may trail the newest one."""
    return with_event_time(heartbeats).withWatermark(
        "event_time", f"{out_of_order_seconds} seconds")


def _windowed(heartbeats, seconds, dims):
    """Windowed rows; every event counts, absent numbers as 0 and absent text as empty."""
    timed = heartbeats if "event_time" in heartbeats.columns else with_event_time(heartbeats)
    return timed.select(
        F.window("event_time", f"{seconds} seconds").alias("window"),
        *[text_or_empty(F.col(d)).alias(d) for d in dims],
        text_or_empty(F.col("device_id")).alias("device_id"),
        number_or_zero(F.col("latency_ms")).alias("latency_ms"),
    )


def _flat(aggregated, seconds, dims):
    start = F.col("window.start")
    return aggregated.select(
        start.alias("window_start"),
        (start + F.make_dt_interval(secs=F.lit(seconds))).alias("window_end"),
        *dims,
        F.col("count"), F.col("distinct_count"),
        (F.col("latency_sum") / F.col("count")).alias("avg_latency"),
        *schema.PERCENTILES,
    )


def _per_device(windowed, keys, *more):
    """Rows per (key, device). A hot key is spread over its devices, a hot
    device is folded before the shuffle, and an absent device id is the empty one."""
    return windowed.groupBy(*keys, "device_id").agg(
        F.count("*").alias("count"), F.sum("latency_ms").alias("latency_sum"), *more)


def _by_key(per_device, keys, *more):
    return per_device.groupBy(*keys).agg(
        F.sum("count").alias("count"), F.sum("latency_sum").alias("latency_sum"),
        F.count("*").alias("distinct_count"), *more)


def _from_sketch(aggregated):
    return reduce(
        lambda df, item: df.withColumn(
            item[0], sketches.sketch_percentile(F.col("latency_sketch"), item[1])),
        schema.PERCENTILES.items(), aggregated)


def _approx_percentiles():
    points = F.array(*[F.lit(p) for p in schema.PERCENTILES.values()])
    found = F.percentile_approx("latency_ms", points, APPROX_ACCURACY)
    return found.alias("points")


def _from_points(aggregated):
    return reduce(
        lambda df, item: df.withColumn(item[1], F.col("points")[item[0]]),
        enumerate(schema.PERCENTILES), aggregated)


def _one_pass(windowed, keys, quantiles):
    """Everything bounded: a single shuffle of one small row per key and map task."""
    state = [F.count("*").alias("count"), F.sum("latency_ms").alias("latency_sum"),
             F.hll_sketch_estimate(sketches.device_sketch()).alias("distinct_count")]
    if quantiles == "sketch":
        return _from_sketch(windowed.groupBy(*keys).agg(
            *state, sketches.latency_sketch().alias("latency_sketch")))
    return _from_points(windowed.groupBy(*keys).agg(*state, _approx_percentiles()))


def _device_and_cell_rows(windowed, keys, distinct):
    """Two small kinds of rows per key, folded before any shuffle: one per device, one per value cell.

    A hot key is spread over its devices and cells. Approximate distinct folds all devices into one
    row with a sketch.
    """
    device = F.col("device_id") if distinct == "exact" else F.lit(None).cast("string")
    none = F.lit(None)
    both = windowed.select(*keys, "device_id", "latency_ms", F.explode(F.array(
        F.struct(F.lit(False).alias("is_cell"), device.alias("device"), none.cast("double").alias("cell")),
        F.struct(F.lit(True).alias("is_cell"), none.cast("string").alias("device"),
                 cells.cell_of(F.col("latency_ms")).alias("cell")))).alias("row"))
    more = []
    if distinct == "approx":
        hashed = F.when(~F.col("is_cell"), F.xxhash64("device_id"))
        more = [F.hll_sketch_agg(hashed, F.lit(sketches.HLL_LOG2_BUCKETS)).alias("device_sketch")]
    return both.select(*keys, "row.*", "device_id", (F.col("latency_ms") + F.lit(0.0)).alias("latency_ms")).groupBy(
        *keys, "is_cell", "device", "cell").agg(
        *cells.cell_counts("latency_ms"), F.sum("latency_ms").alias("latency_sum"), *more)


def _with_cells(windowed, keys, distinct):
    """Counts, distinct devices and a value histogram per key: the same in a stream and in a batch.

    A batch groups by the start of the window, which costs far less than both its ends; a stream keeps the
    whole window as its watermark and the keys of its stored state need it.
    """
    if windowed.isStreaming:
        return _folded_rows(_device_and_cell_rows(windowed, keys, distinct), keys, distinct)
    started = windowed.withColumn("window", F.col("window.start"))
    found = _folded_rows(_device_and_cell_rows(started, keys, distinct), keys, distinct)
    return found.withColumn("window", F.struct(F.col("window").alias("start")))


def _folded_rows(rows, keys, distinct):
    device = ~F.col("is_cell")
    unique = (F.count_if(device) if distinct == "exact"
              else F.hll_sketch_estimate(F.hll_union_agg("device_sketch")))
    return rows.groupBy(*keys).agg(
        F.sum(F.when(device, F.col("n"))).alias("count"), F.sum(F.when(device, F.col("latency_sum"))).alias("latency_sum"),
        unique.alias("distinct_count"), cells.gathered(F.col("is_cell")))


def _batched(windowed, dims, quantiles):
    # one long of the window is enough to tell groups apart
    start = F.struct(F.col("window.start").alias("start"))
    keyed = windowed.select(
        F.struct(start.alias("window"), *dims).alias("key"), "device_id", "latency_ms")
    summary = _by_key(_per_device(keyed, ["key"]), ["key"])
    if quantiles == "exact":
        # one row per window: kept, as its counts also decide how percentiles are found
        summary = saved(summary, "window-counts")
        points = percentiles_by_key(keyed, "latency_ms", schema.PERCENTILES, sizes=summary)
    elif quantiles == "approx":
        points = _from_points(keyed.groupBy("key").agg(_approx_percentiles())).drop("points")
    else:
        points = _from_sketch(keyed.groupBy("key").agg(
            sketches.latency_sketch().alias("latency_sketch"))).drop("latency_sketch")
    return summary.join(points, "key", "left").select("key.*", *[
        c for c in (*summary.columns, *points.columns) if c != "key"])


def window_aggregate(heartbeats, seconds=schema.WINDOW_SECONDS, dims=schema.DIMENSIONS,
                     quantiles=None, distinct="exact"):
    """Count, distinct devices, mean and p50/p95/p99 latency per window and dimensions.

    ``quantiles``: ``exact`` (batch default), ``cells`` (the only one of a stream, and the way to write
    what a stream would have), ``approx`` or ``sketch``; ``distinct``: ``exact`` or ``approx``. A batch emits
    every window; a stream (``with_watermark`` first, append mode) emits each window once, on close.
    """
    streaming = heartbeats.isStreaming
    quantiles = quantiles or ("cells" if streaming else "exact")
    if quantiles not in ("exact", "cells", "approx", "sketch") or distinct not in ("exact", "approx"):
        raise ValueError("quantiles: exact|cells|approx|sketch, distinct: exact|approx")
    if streaming and quantiles != "cells":
        raise ValueError("a stream keeps percentile state that merges by addition: use quantiles='cells'")
    windowed = _windowed(heartbeats, seconds, dims)
    if quantiles == "cells":
        return _flat(cells.with_percentiles(_with_cells(windowed, ["window", *dims], distinct)), seconds, dims)
    if distinct == "approx" and quantiles != "exact":
        return _flat(_one_pass(windowed, ["window", *dims], quantiles), seconds, dims)
    if distinct == "approx":
        raise ValueError("approx distinct goes with approx or sketch quantiles")
    return _flat(_batched(windowed, dims, quantiles), seconds, dims)


def windows_of_state(state, seconds, dims=schema.DIMENSIONS):
    """Windows as they stand in a stream's state: its (key, value) rows of devices and cells."""
    rows = state.select("key.*", F.col("value.count").alias("n"), F.col("value.min").alias("lo"),
                        F.col("value.max").alias("hi"), F.col("value.sum").alias("latency_sum"))
    return _flat(cells.with_percentiles(_folded_rows(rows, ["window", *dims], "exact")), seconds, dims)


def cell_windows(heartbeats, seconds=schema.WINDOW_SECONDS, dims=schema.DIMENSIONS):
    """Windows stored with their value histogram, for ``cells.merge_cell_rows``."""
    stored = _with_cells(_windowed(heartbeats, seconds, dims), ["window", *dims], "exact")
    start = F.col("window.start")
    return stored.select(
        start.alias("window_start"), (start + F.make_dt_interval(secs=F.lit(seconds))).alias("window_end"),
        *dims, "count", "distinct_count", "latency_sum", "cells")


def sketch_windows(heartbeats, seconds=schema.WINDOW_SECONDS, dims=schema.DIMENSIONS, **sizes):
    """Windows stored as mergeable sketches, for ``sketches.merge_sketch_rows``; ``sizes`` as ``k``."""
    stored = sketches.sketch_rows(_windowed(heartbeats, seconds, dims), ["window", *dims], **sizes)
    return stored.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *dims, "count", "latency_sum", "device_sketch", "latency_sketch")
