"""Mergeable window state: distinct devices as HLL, latency as KLL.

Both sketches have a fixed upper size, are combined before the shuffle, and
can be stored per window and merged later for any coarser group.
"""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import text_or_empty

KLL_K = 4096
HLL_LOG2_BUCKETS = 14
THETA_LOG2_ENTRIES = 12


def latency_sketch(column="latency_ms", k=KLL_K):
    return F.kll_sketch_agg_double(F.col(column), F.lit(k))


def merged_latency(column="latency_sketch", k=KLL_K):
    return F.kll_merge_agg_double(F.col(column), F.lit(k))


def sketch_percentile(sketch, p):
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(p)))


def device_sketch(column="device_id", log2_buckets=HLL_LOG2_BUCKETS):
    # hashed first, as the sketch passes over empty text
    return F.hll_sketch_agg(F.xxhash64(text_or_empty(F.col(column))), F.lit(log2_buckets))


def devices_missing(rows, keys, before, after, log2_entries=THETA_LOG2_ENTRIES):
    """Per ``keys``, estimates of the devices where ``before`` holds, of those missing where ``after``
    holds, and of all of both: one pass and one shuffle of sketches."""
    held = rows.groupBy(*keys).agg(*[
        F.theta_sketch_agg(F.when(condition, F.xxhash64(text_or_empty(F.col("device_id")))), F.lit(log2_entries)).alias(name)
        for name, condition in (("first", before), ("second", after))])
    return held.select(
        *keys, F.theta_sketch_estimate("first").alias("devices_before"),
        F.theta_sketch_estimate(F.theta_difference("first", "second")).alias("devices_missing"),
        F.theta_sketch_estimate(F.theta_union("first", "second", F.lit(log2_entries))).alias("devices_of_both"))


def sketch_rows(keyed, keys, k=KLL_K, log2_buckets=HLL_LOG2_BUCKETS):
    """Stored form: count, latency sum and the two sketches per key."""
    return keyed.groupBy(*keys).agg(
        F.count("*").alias("count"),
        F.sum("latency_ms").alias("latency_sum"),
        device_sketch(log2_buckets=log2_buckets).alias("device_sketch"),
        latency_sketch(k=k).alias("latency_sketch"),
    )


def merge_sketch_rows(stored, keys=(), k=KLL_K):
    """Roll stored windows up to ``keys``: true percentiles and distinct devices of the whole."""
    merged = stored.groupBy(*keys).agg(
        F.sum("count").alias("count"),
        F.sum("latency_sum").alias("latency_sum"),
        F.hll_union_agg("device_sketch").alias("device_sketch"),
        merged_latency(k=k).alias("latency_sketch"),
    )
    return merged.select(
        *keys, "count",
        F.hll_sketch_estimate("device_sketch").alias("distinct_count"),
        (F.col("latency_sum") / F.col("count")).alias("avg_latency"),
        *[sketch_percentile(F.col("latency_sketch"), p).alias(n)
          for n, p in schema.PERCENTILES.items()],
    )
