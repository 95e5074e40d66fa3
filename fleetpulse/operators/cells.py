"""Value histograms that merge by addition: one percentile state for stream, table and batch.

A cell is a value rounded to its ``CELL_BITS`` leading bits, so cells keep the order of values and
a cell's values lie within ``RELATIVE_ERROR`` of each other. Per cell the state holds the number of
rows, the smallest and the largest value. Histograms merge by adding the numbers: no order of merging and no
split of the rows changes the result, so a stream, stored windows rolled up and a batch agree.

A percentile takes the point between the two neighbours of rank p * (n - 1), as the exact one does. The
value at a rank inside a cell lies between the cell's ends; it is exact where the cell holds one or two rows
or equal values, and otherwise off by at most ``RELATIVE_ERROR`` of itself. A group has at most
2 ** (CELL_BITS - 1) cells for each doubling of the value, whatever its rows.
"""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators.percentiles import leading_bits

CELL_BITS = 10
#: Width of a cell against its values.
RELATIVE_ERROR = 2.0 ** (1 - CELL_BITS)


def cell_of(value):
    """The cell of a number; both zeros share one."""
    return leading_bits(value + F.lit(0.0), CELL_BITS)


def cell_counts(value):
    """Aggregates of one cell."""
    return F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")


def merged_counts():
    return F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")


def gathered(condition=None):
    """All cells of a group as one list; the group's rows must be cells already."""
    entry = F.struct("cell", "n", "lo", "hi")
    return F.collect_list(entry if condition is None else F.when(condition, entry)).alias("cells")


def with_percentiles(rows, probabilities=None, cells="cells", total="count"):
    """``rows`` with percentile columns in place of their list of cells, which holds ``total`` rows."""
    wanted = schema.PERCENTILES if probabilities is None else probabilities
    spots = {name: F.lit(float(p)) * (F.col(total) - 1) for name, p in wanted.items()}
    ranks = [rank(at) for at in spots.values() for rank in (F.floor, F.ceil)]
    fields = [f"v{i}" for i in range(len(ranks))]
    none = F.lit(None).cast("double")
    start = F.struct(F.lit(0).cast("long").alias("before"), *[none.alias(f) for f in fields])

    def passed(state, cell):
        def at(rank, known):
            inside = rank - state["before"]
            step = (cell["hi"] - cell["lo"]) / F.greatest(cell["n"] - 1, F.lit(1))
            value = F.when(inside == cell["n"] - 1, cell["hi"]).otherwise(cell["lo"] + inside * step)
            return F.when((inside >= 0) & (inside < cell["n"]), value).otherwise(known)
        return F.struct((state["before"] + cell["n"]).alias("before"),
                        *[at(rank, state[f]).alias(f) for rank, f in zip(ranks, fields)])

    kept = [c for c in rows.columns if c != cells]
    found = rows.select(*kept, F.aggregate(F.sort_array(cells), start, passed).alias("_found"))
    columns = []
    for i, (name, at) in enumerate(spots.items()):
        below, above, part = F.col(f"_found.v{2 * i}"), F.col(f"_found.v{2 * i + 1}"), at - F.floor(at)
        columns.append(F.when(below == above, below).otherwise(below * (1 - part) + above * part).alias(name))
    return found.select(*kept, *columns)


def merge_cell_rows(stored, keys=()):
    """Roll stored windows with ``cells`` up to ``keys``: percentiles of the whole, as if made at once."""
    # a window's numbers go with its first cell, so that the windows are read, or made, once
    listed = stored.select(*keys, "count", "latency_sum", F.posexplode_outer("cells").alias("place", "entry"))
    first = F.coalesce("place", F.lit(0)) == 0
    folded = listed.select(*keys, "entry.*", *[F.when(first, F.col(c)).alias(c) for c in ("count", "latency_sum")])
    sums = F.sum("count").alias("count"), F.sum("latency_sum").alias("latency_sum")
    merged = (folded.groupBy(*keys, "cell").agg(*sums, *merged_counts())
              .groupBy(*keys).agg(*sums, gathered(F.col("n").isNotNull())))
    rolled = merged.withColumn("avg_latency", F.col("latency_sum") / F.col("count")).drop("latency_sum")
    return with_percentiles(rolled)
