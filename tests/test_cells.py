import math
import random

import pytest
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators import cells, windows
from fleetpulse.operators.percentiles import grouped_percentiles
from tests.helpers import NOW_MS, beat, beats, plan_of, rows_of

START = NOW_MS - NOW_MS % 3_600_000


def near(found, exact):
    return abs(found - exact) <= abs(exact) * cells.RELATIVE_ERROR


def interpolated(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize("values", [
    [0.0], [5.0, 5.0, 5.0], [-0.0, 0.0], [1.0, 2.0], [3.25, 1e300, 1e-300], list(map(float, range(1000))),
    [random.Random(3).lognormvariate(3, 2) for _ in range(3000)], [7.0 + i / 10_000 for i in range(500)],
])
def test_percentiles_within_the_bound(spark, values):
    df = beats(spark, [beat(f"d{i % 3}", at=START + i % 1000, latency=v) for i, v in enumerate(values)])
    found = windows.window_aggregate(df, 3600, quantiles="cells").first()
    assert found["count"] == len(values) and found.distinct_count == min(3, len(values))
    for name, p in schema.PERCENTILES.items():
        assert near(found[name], interpolated(values, p))
    if len(values) <= 2:
        assert [found[n] for n in schema.PERCENTILES] == [interpolated(values, p) for p in schema.PERCENTILES.values()]


def test_large_groups_stay_within_the_bound(spark):
    df = spark.range(400_000, numPartitions=6).select(
        F.concat(F.lit("d"), (F.col("id") % 500).cast("string")).alias("device_id"),
        F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 3 / 2 + 1).cast("int")).alias("region"),
        F.lit("ok").alias("status"), F.lit(START).alias("timestamp_ms"), (F.exp(F.rand(5) * 9) - 1).alias("latency_ms"))
    kept = df.cache()
    exact = {r.region: r for r in grouped_percentiles(kept, ["region"], "latency_ms", schema.PERCENTILES).collect()}
    for r in windows.window_aggregate(kept, 3600, quantiles="cells").collect():
        assert r["count"] > 100_000 and r.distinct_count == 500
        assert all(near(r[n], exact[r.region][n]) for n in schema.PERCENTILES)
    kept.unpersist()


def test_merging_does_not_depend_on_the_split(spark):
    rng = random.Random(8)
    rows = [beat(f"d{i % 9}", rng.choice(["a", "b"]), at=START + rng.randrange(36_000_000), latency=rng.expovariate(0.01))
            for i in range(4000)]
    df = beats(spark, rows)
    found = [rows_of(cells.merge_cell_rows(windows.cell_windows(df.repartition(n), seconds), ["region"]),
                     "region", "count", *schema.PERCENTILES) for n, seconds in ((1, 60), (5, 3600), (3, 86_400))]
    assert found[0] == found[1] == found[2]
    whole = cells.merge_cell_rows(windows.cell_windows(df, 60))
    assert whole.first()["count"] == 4000


def test_nothing_and_null_latencies(spark):
    assert windows.window_aggregate(beats(spark, []), quantiles="cells").count() == 0
    found = windows.window_aggregate(beats(spark, [beat(latency=None), beat(latency=4.0)]), quantiles="cells").first()
    assert (found["count"], found.avg_latency, found.p50_latency) == (2, 2.0, 2.0)


def test_one_shuffle_of_folded_rows_before_the_windows(spark):
    plan = plan_of(windows.window_aggregate(beats(spark, [beat()]), quantiles="cells"))
    assert plan.count("Exchange") == 2 and "Scan" in plan and "Join" not in plan


def test_merging_makes_the_windows_once(spark):
    df = beats(spark, [beat(latency=float(i), at=START + i) for i in range(5)])
    plan = plan_of(cells.merge_cell_rows(windows.cell_windows(df, 60), ["region"]))
    assert plan.count("Scan") == 1 and "Join" not in plan


def test_merged_sums_do_not_depend_on_the_number_of_cells(spark):
    shape = "region string, count bigint, latency_sum double, cells array<struct<cell double, n bigint, lo double, hi double>>"
    two, one = [(1.0, 2, 1.0, 1.0), (8.0, 1, 8.0, 8.0)], [(4.0, 1, 4.0, 4.0)]
    stored = spark.createDataFrame([("a", 3, 10.0, two), ("a", 1, 4.0, one), ("b", 1, 4.0, one)], shape)
    columns = ("count", "avg_latency", "p50_latency")
    assert rows_of(cells.merge_cell_rows(stored, ["region"]), "region", *columns) == [("a", 4, 3.5, 2.5), ("b", 1, 4.0, 4.0)]
    assert rows_of(cells.merge_cell_rows(stored), *columns) == [(5, 3.6, 4.0)]
    assert rows_of(cells.merge_cell_rows(stored.limit(0)), *columns) == [(None, None, None)]


def test_a_batch_groups_by_the_start_of_a_window_alone(spark):
    stored = windows.cell_windows(beats(spark, [beat(at=START + 1)]), 60)
    assert ", end, " not in plan_of(stored)
    row = stored.first()
    assert (row.window_end - row.window_start).total_seconds() == 60
