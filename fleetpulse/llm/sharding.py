"""Sharding by best-fit decreasing over groups of equal texts (law: bytes).

Groups never split. They are sorted by size and each enters the fullest shard that
still has room. The plan is made over size classes: sizes up to ``EXACT_SIZES`` are
classes of their own, larger ones are rounded up to 11 leading bits. That gives
at most about 120,000 classes whatever the table holds, so that the plan fits the
driver, while groups and documents stay on the executors and are placed by their
rank within their class. Capacity is the least at which all groups fit into the
given number of shards; a group too large for an even share has a shard to itself.

Null text has no bytes, as empty text, and is in its group. Rows that repeat a doc_id
are documents of their own. An empty table gives an empty result. Columns other than
doc_id and text are ignored.
"""

import bisect

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.llm.common import shuffle_width, text_or_empty, written

ROW_OVERHEAD = 16
EXACT_SIZES = 1 << 16
LEADING_BITS = 11
STEP = f"shiftleft(1L, length(bin(group_bytes)) - {LEADING_BITS})"


def size_class():
    """The least class size that holds ``group_bytes``: itself, or rounded up if large."""
    return F.expr(f"""CASE WHEN group_bytes <= {EXACT_SIZES} THEN group_bytes ELSE
        (group_bytes + {STEP} - 1) DIV {STEP} * {STEP} END""")


def best_fit(classes, shards, capacity):
    """[(class size, shard, count)] for classes [(size, count)] of falling size, or None.

    The shards with room are a sorted list of (room, shard), searched by bisection:
    the tightest shard that holds a group takes as many of its class as fit, as it
    stays the tightest until it is too full.
    """
    rooms = [(capacity, shard) for shard in range(shards)]
    placed = []
    for size, count in classes:
        while count:
            at = bisect.bisect_left(rooms, (size, -1))
            if at == len(rooms):
                return None
            room, shard = rooms.pop(at)
            taken = min(count, room // size)
            placed.append((size, shard, taken))
            count -= taken
            bisect.insort(rooms, (room - taken * size, shard))
    return placed


def even_plan(classes, shards):
    """Best-fit plan at the least capacity; oversized groups first get shards of their own."""
    total, placed, used = sum(s * n for s, n in classes), [], 0
    rest = []
    for size, count in classes:
        while count and used < shards - 1 and size * (shards - used) >= total:
            placed.append((size, used, 1))
            used, total, count = used + 1, total - size, count - 1
        if count:
            rest.append((size, count))
    low = max(-(-total // (shards - used)), rest[0][0] if rest else 0)
    high = low + (rest[0][0] if rest else 0)
    best = best_fit(rest, shards - used, high)
    while low < high:
        middle = (low + high) // 2
        found = best_fit(rest, shards - used, middle)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return placed + [(size, shard + used, n) for size, shard, n in best or []]


def numbered(df, keys, spread, name):
    """Rows numbered from 0 within ``keys``, gapless, whatever a key's share of the rows.

    Each key is cut by a hash of the ``spread`` columns; parts are counted, and a row's
    number is the total of the parts before its own plus its number there.
    """
    parts = shuffle_width(df.sparkSession) * 4
    cut = df.withColumn("__part", F.pmod(F.xxhash64(*spread), F.lit(parts)))
    counts = cut.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    before = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*keys, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = W.partitionBy(*keys, "__part").orderBy(*spread)
    local = cut.withColumn("__row", F.row_number().over(inside) - 1)
    return local.join(starts, [*keys, "__part"]).withColumn(
        name, (F.col("__start") + F.col("__row")).cast("long")).drop("__part", "__row", "__start")


def sharded(docs, shards=40):
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each document."""
    spark = docs.sparkSession
    text = F.encode(text_or_empty(), "utf-8")
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest")), "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_bytes")).withColumn(
        "size_class", size_class())
    counted = groups.groupBy("size_class").agg(F.count("*").alias("n")).orderBy(F.desc("size_class"))
    plan, ranges, taken = even_plan([tuple(r) for r in counted.collect()], shards), [], {}
    for size, shard, count in plan:
        start = taken.get(size, 0)
        ranges.append((size, shard, start, start + count))
        taken[size] = start + count
    placed = spark.createDataFrame(ranges, "size_class long, shard int, first long, past long")

    ranked = numbered(groups, ["size_class"], ["digest"], "rank")
    homes = ranked.join(F.broadcast(placed), "size_class").filter(
        "rank >= first and rank < past").select("digest", "shard")
    at_home = rows.join(homes, "digest").select("doc_id", "size", "text_crc32", "shard")
    slots = numbered(at_home, ["shard"], ["doc_id", "text_crc32", "size"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
