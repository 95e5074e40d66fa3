"""What several operators of this folder share."""

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetpulse.session import scratch_path


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df, label):
    """Write ``df`` below ``spark.checkpoint.dir`` and read it from there.

    Cuts the lineage: executors lost later cost a read, not the computation. The write's own
    shuffle files are removed as soon as it has ended.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def joined_evenly(rows, folded, key, each=4):
    """``rows`` joined with ``folded``, which has one row for each ``key`` and its number of rows as ``n``.

    Keys with more than an even share of the rows, of which there are at most ``each`` for each shuffle partition,
    are joined by broadcast where their rows are, the others by shuffle. Both tables are read twice and
    should be written ones. The columns are those of ``rows``, then of ``folded`` without key and ``n``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    total = folded.agg(F.sum("n")).first()[0] or 0
    bar = max(1, total // (each * shuffle_width(rows.sparkSession)))
    heavy, told = folded.filter(F.col("n") > bar), [c for c in folded.columns if c != "n"]
    light = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(
        folded.filter(F.col("n") <= bar).select(*told), keys)
    columns = [*rows.columns, *[c for c in told if c not in keys]]
    return light.select(*columns).unionByName(rows.join(F.broadcast(heavy.select(*told)), keys).select(*columns))


def shuffle_width(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release_shuffles(spark):
    """Let Spark delete the shuffle files of results that nothing refers to any more.

    They go when the driver's JVM collects garbage, which by itself may be half an hour away,
    and only once Python has let go of its side.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(name="text"):
    return F.coalesce(F.col(name), F.lit(""))


def in_blocks(batches, rows):
    """Arrow batches regrouped into tables of ``rows`` rows, the last one shorter."""
    held, count = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - count)
            held.append(part)
            count += part.num_rows
            batch = batch.slice(part.num_rows)
            if count == rows:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def binaries(chunks):
    return pa.array(chunks, pa.binary())


def mixed(x):
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E6C63D0876A9A35)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
