"""What a windows query holds between two runs, read from its checkpoint."""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators.windows import windows_of_state


def operators(spark, checkpoint):
    """One row per stateful operator and store of the last commit; the one next to the source has the highest id."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(spark, checkpoint, operator_id):
    return spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)


def open_windows(spark, checkpoint, seconds=schema.WINDOW_SECONDS, dims=schema.DIMENSIONS):
    """The windows a query has seen but not emitted, with all their figures so far.

    For queries with exact distinct counts. Reads the last committed state; the query may run on.
    """
    first = operators(spark, checkpoint).agg(F.max("operatorId")).first()[0]
    return windows_of_state(state_rows(spark, checkpoint, first), seconds, dims)


def state_sizes(spark, checkpoint):
    """operator_id, operator, rows, and the rows of its fullest partition: how much and how even the state is."""
    found = None
    for op in operators(spark, checkpoint).select("operatorId", "operatorName").distinct().collect():
        parts = state_rows(spark, checkpoint, op.operatorId).groupBy("partition_id").agg(F.count("*").alias("n"))
        sizes = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("fullest"))
        one = sizes.select(F.lit(op.operatorId).alias("operator_id"), F.lit(op.operatorName).alias("operator"), "rows", "fullest")
        found = one if found is None else found.unionByName(one)
    return found


def state_progress(query):
    """Rows and bytes of each stateful operator after the last micro-batch of a query."""
    last = query.lastProgress
    return [{"operator": op["operatorName"], "rows": op["numRowsTotal"], "bytes": op["memoryUsedBytes"]}
            for op in (last["stateOperators"] if last else [])]
