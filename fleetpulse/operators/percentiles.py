"""Exact percentiles per group, without gathering a large group in one task.

Spark's own ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here groups are counted first. One of at most
``GROUP_ROWS`` rows is gathered and sorted as an array of that bounded length.
In a larger one the wanted ranks are located by counting. A cell is a value
rounded to its leading bits, so cells keep the order of values:

1. count rows per (group, cell), combined before the shuffle, so that only
   counts travel; keep the cells in which a wanted rank falls and write them
   to the shared scratch folder;
2. fetch the rows of the kept cells and fold equal values;
3. while a kept cell holds more rows than one task should sort, count again
   with finer cells inside the kept ones, over a written copy of what was fetched;
4. rank what is left.

After the count of the groups, which is left out where all go by cells anyway, the rows are read twice.

All groups go by cells where that moves far fewer rows, which holds from some
thousand rows per group on. Kept cells and the keys of large groups are
broadcast when their counted number is small; otherwise all groups go by cells,
equal values are folded first and both sides are shuffled by (group, cell).

A cell depends on the value alone and the kept cells are a written table, so a
task that runs again after a loss meets the same ones. The rows must read the
same in every pass.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetpulse.session import saved

DOUBLE_BITS = 53
# Rows of a group that may be gathered in one array: some 20 MB.
GROUP_ROWS = 500_000
# From these totals and mean group sizes on, cell counts are far fewer than rows to gather.
COUNTING_ROWS = 2_000_000
COUNTING_GROUP_ROWS = 1000
# 64 cells per doubling of the value keep the first counts small; each later pass splits
# a cell into at most 2**16 finer ones; at 53 bits a cell is one value.
CELL_BITS = (7, 22, 37, DOUBLE_BITS)
# Rows of one cell that one task may sort.
CELL_ROWS = 4_000_000
# Kept cells or large groups to broadcast: about 150 bytes each, so 75 MB at most.
BROADCAST_CELLS = 500_000


def leading_bits(value, bits):
    """Round a double to ``bits`` significant bits; order is kept."""
    if bits >= DOUBLE_BITS:
        return value
    factor = float(2 ** (DOUBLE_BITS - bits) + 1)
    safe = 2.0 ** (1023 - (DOUBLE_BITS - bits) - 1)
    scaled = value * F.lit(factor)
    return F.when(F.abs(value) < F.lit(safe), scaled - (scaled - value)).otherwise(value)


def _interpolated_ranks(total, p):
    at = F.lit(float(p)) * (total - 1)
    return F.floor(at), F.ceil(at), at


def _nearest_rank(total, p):
    if p <= 0:
        return F.lit(0).cast("long")
    if p >= 1:
        return total - 1
    return F.greatest(F.ceil(F.lit(float(p)) * total) - 1, F.lit(0)).cast("long")


def _holds_a_rank(probabilities, method):
    total, first = F.col("total"), F.col("before")
    if method == "nearest":
        ranks = [_nearest_rank(total, p) for p in probabilities]
    else:
        ranks = [r for p in probabilities for r in _interpolated_ranks(total, p)[:2]]
    return F.exists(F.array(*ranks), lambda r: (r >= first) & (r < first + F.col("n")))


def _running_before(partition, order):
    to_here = (Window.partitionBy(*partition).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum("n").over(to_here) - F.col("n")


def _first_cells(rows):
    """Counts per leading-bits cell: no more rows per key than coarse cells exist."""
    counts = (rows.groupBy("key", leading_bits(F.col("v"), CELL_BITS[0]).alias("cell"))
              .agg(F.count("*").alias("n")))
    return counts.select(
        "key", "cell", "n", _running_before(["key"], "cell").alias("before"),
        F.sum("n").over(Window.partitionBy("key")).alias("total"))


def _in_cells(rows, bits, cells, small):
    """(key, cell, before, total, v, n): the rows (key, v, n) of the kept cells, equal values folded."""
    celled = rows.withColumn("cell", leading_bits(F.col("v"), bits))
    kept = cells.drop("n")
    if small:
        near = celled.join(F.broadcast(kept), ["key", "cell"])
        return near.groupBy("key", "cell", "before", "total", "v").agg(F.sum("n").alias("n"))
    folded = celled.groupBy("key", "cell", "v").agg(F.sum("n").alias("n"))
    return folded.join(kept, ["key", "cell"])


def _finer_cells(near, bits):
    finer = (near.groupBy("key", F.col("cell").alias("wide"), "before", "total",
                          leading_bits(F.col("v"), bits).alias("cell"))
             .agg(F.sum("n").alias("n")))
    return finer.withColumn(
        "before", F.col("before") + _running_before(["key", "wide"], "cell")).drop("wide")


def _kept(cells, wanted):
    """The cells that hold a wanted rank, whether they are few, and the largest size."""
    stored = saved(cells.where(wanted), "rank-cells")
    number, largest = stored.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    return stored, number <= BROADCAST_CELLS, largest


def _ranked(rows, probabilities, method):
    """(key, v, n, before, total) of the values at the wanted ranks."""
    wanted = _holds_a_rank(probabilities, method)
    cells, small, largest = _kept(_first_cells(rows), wanted)
    near = _in_cells(rows.withColumn("n", F.lit(1).cast("long")), CELL_BITS[0], cells, small)
    if largest > CELL_ROWS:
        near = saved(near, "rank-rows")
    for finer in CELL_BITS[1:]:
        if largest <= CELL_ROWS:
            break
        cells, small, largest = _kept(_finer_cells(near, finer), wanted)
        near = _in_cells(near.select("key", "v", "n"), finer, cells, small)
    return near.withColumn(
        "before", F.col("before") + _running_before(["key", "cell"], "v")).where(wanted)


def _value_columns(probabilities, method, value_at):
    """Result columns over ``total`` and a function from rank to value."""
    total, columns = F.col("total"), []
    for name, p in probabilities.items():
        if method == "nearest":
            columns.append(value_at(_nearest_rank(total, p)).alias(name))
            continue
        low, high, at = _interpolated_ranks(total, p)
        below, above, part = value_at(low), value_at(high), at - low
        columns.append(F.when(below == above, below)
                       .otherwise(below * (1 - part) + above * part).alias(name))
    return columns


def _by_array(rows, probabilities, method):
    """Groups of a checked size: one sorted array each."""
    gathered = rows.groupBy("key").agg(F.sort_array(F.collect_list("v")).alias("values"))
    sized = gathered.withColumn("total", F.size("values").cast("long"))
    return sized.select("key", *_value_columns(
        probabilities, method, lambda rank: F.get("values", rank.cast("int"))))


def _by_cells(rows, probabilities, method):
    """Groups of any size: the few values at the wanted ranks as one short list each."""
    found = _ranked(rows, list(probabilities.values()), method)
    spans = found.groupBy("key", "total").agg(
        F.collect_list(F.struct("before", "n", "v")).alias("spans"))

    def value_at(rank):
        return F.filter("spans", lambda s: (rank >= s["before"]) & (rank < s["before"] + s["n"]))[0]["v"]

    return spans.select("key", *_value_columns(probabilities, method, value_at))


def group_sizes(rows):
    return saved(rows.groupBy("key").agg(F.count("*").alias("count")), "group-sizes")


def percentiles_by_key(rows, value, probabilities, method="interpolated", group_rows=None,
                       sizes=None):
    """``rows`` carry a struct column ``key``; gives one row per key, a column per probability.

    ``probabilities`` maps output column names to numbers in 0..1. ``interpolated``
    takes the point between the two neighbours of rank p*(n-1); ``nearest`` takes
    the value of rank ceil(p*n), the smallest for p <= 0 and the largest for p >= 1.
    ``group_rows`` lowers the size up to which groups are gathered; ``sizes`` is a stored
    table of key and count where the caller has counted the groups.
    """
    if method not in ("interpolated", "nearest"):
        raise ValueError("method must be interpolated or nearest")
    # one zero: the ways below would give back either sign of it
    v = F.col(value).cast("double") + F.lit(0.0)
    present = rows.where(v.isNotNull()).select("key", F.coalesce(v, F.lit(math.nan)).alias("v"))
    cap = GROUP_ROWS if group_rows is None else min(group_rows, GROUP_ROWS)
    if cap <= 0:
        # every group goes by cells, whose counts hold the sizes
        return _by_cells(present, probabilities, method)
    sizes = group_sizes(present) if sizes is None else sizes
    large = F.col("count") > cap
    groups, many, total = sizes.agg(
        F.count("*"), F.count_if(large), F.coalesce(F.sum("count"), F.lit(0))).first()
    counts_are_fewer = total > COUNTING_ROWS and total >= COUNTING_GROUP_ROWS * groups
    if many == groups > 0 or many > BROADCAST_CELLS or counts_are_fewer:
        return _by_cells(present, probabilities, method)
    if many == 0:
        return _by_array(present, probabilities, method)
    keys = F.broadcast(sizes.where(large).select("key"))
    return _by_cells(present.join(keys, "key", "left_semi"), probabilities, method).unionByName(
        _by_array(present.join(keys, "key", "left_anti"), probabilities, method))


def grouped_percentiles(df, keys, value, probabilities, method="interpolated", group_rows=None):
    """Exact percentiles of ``value`` by the named key columns; null keys form a group."""
    keyed = df.select(F.struct(*keys).alias("key"), F.col(value).alias("value"))
    found = percentiles_by_key(keyed, "value", probabilities, method, group_rows)
    return found.select("key.*", *probabilities)


def total_percentiles(df, value, probabilities, method="interpolated"):
    """Exact percentiles over all rows: always one row, zeros when there are none."""
    keyed = df.select(F.struct(F.lit(0).alias("all")).alias("key"), F.col(value).alias("value"))
    found = percentiles_by_key(keyed, "value", probabilities, method)
    return found.agg(*[F.coalesce(F.max(n), F.lit(0.0)).alias(n) for n in probabilities])


def nearest_rank_percentiles(df, keys, value, probabilities):
    """The load report's percentile: an observed value, never a point between two."""
    return grouped_percentiles(df, keys, value, probabilities, "nearest")
