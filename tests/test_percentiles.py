import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetpulse.operators import percentiles
from fleetpulse.operators.percentiles import (
    grouped_percentiles, leading_bits, nearest_rank_percentiles, total_percentiles,
)

POINTS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


# GROUP_ROWS, CELL_ROWS, BROADCAST_CELLS
MODES = {
    "arrays": (500_000, 4_000_000, 500_000),
    "arrays and cells": (4, 4_000_000, 500_000),
    "cells": (0, 4_000_000, 500_000),
    "finer cells": (0, 3, 500_000),
    "finer cells and shuffles": (0, 3, 0),
}


@pytest.fixture(params=MODES)
def mode(request, monkeypatch):
    """The same results with the caps so low that every way runs."""
    for name, cap in zip(("GROUP_ROWS", "CELL_ROWS", "BROADCAST_CELLS"), MODES[request.param]):
        monkeypatch.setattr(percentiles, name, cap)


def nearest(values, p):
    values = sorted(values)
    return values[min(max(math.ceil(p * len(values)) - 1, 0), len(values) - 1)]


def groups():
    rng = random.Random(7)
    hot = [rng.expovariate(1 / 20) for _ in range(3000)]
    hot += [1000.0 + i * 1e-9 for i in range(500)] + [17.25] * 2500
    return {
        "hot": hot,
        "signs": [-5.5, -1e-300, 0.0, -0.0, 1e-300, 3.0, -1e200, 1e200],
        "one": [12.5],
        "pair": [1.0, 2.0],
        None: [4.0, 8.0, 16.0],
        "huge": [1.7e308, -1.7e308, 5.0, 1e306],
    }


def frame(spark, data):
    rows = [(k, v) for k, values in data.items() for v in values]
    return spark.createDataFrame(rows, "k string, v double").repartition(5)


def test_interpolated(spark, mode):
    data = groups()
    del data["huge"]
    found = {r.k: r for r in grouped_percentiles(frame(spark, data), ["k"], "v", POINTS).collect()}
    assert set(found) == set(data)
    for key, values in data.items():
        for name, p in POINTS.items():
            assert found[key][name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)


def test_nearest_rank(spark, mode):
    data = groups()
    found = {r.k: r for r in nearest_rank_percentiles(frame(spark, data), ["k"], "v", POINTS).collect()}
    for key, values in data.items():
        for name, p in POINTS.items():
            assert found[key][name] == nearest(values, p)


def test_load_report_case(spark):
    df = frame(spark, {"all": [10.0, 20.0, 30.0, 40.0, 100.0]})
    row = nearest_rank_percentiles(df, ["k"], "v", {"p99": 0.99}).first()
    assert row.p99 == 100.0
    assert df.agg(F.avg("v")).first()[0] == 40.0


def test_nan_sorts_last_and_nulls_do_not_count(spark, mode):
    df = frame(spark, {"a": [1.0, float("nan"), None, 3.0]})
    row = nearest_rank_percentiles(df, ["k"], "v", POINTS).first()
    assert (row.p0, row.p50) == (1.0, 3.0) and math.isnan(row.p100)


def test_total_of_no_rows_is_zero(spark):
    assert total_percentiles(frame(spark, {"a": []}), "v", POINTS).first().asDict() == dict.fromkeys(POINTS, 0.0)
    assert total_percentiles(frame(spark, {"a": [2.0], "b": [4.0]}), "v", {"p": 0.5}).first().p == 3.0


def test_same_as_the_builtin(spark, mode):
    df = frame(spark, groups()).where("k != 'huge'")
    mine = {r.k: (r.a, r.b) for r in grouped_percentiles(df, ["k"], "v", {"a": 0.5, "b": 0.95}).collect()}
    for r in df.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.95))).alias("p")).collect():
        assert mine[r.k] == pytest.approx(tuple(r.p))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=200))
def test_cells_keep_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for bits in percentiles.CELL_BITS:
        pairs = sorted((r.v, r.cell) for r in df.withColumn("cell", leading_bits(F.col("v"), bits)).collect())
        cells = [c for _, c in pairs]
        assert cells == sorted(cells)


def test_method_is_checked(spark):
    with pytest.raises(ValueError):
        grouped_percentiles(frame(spark, {"a": [1.0]}), ["k"], "v", POINTS, "linear")


def test_rows_are_read_twice_however_fine_the_cells(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "CELL_ROWS", 3)
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    values = [100.0 + i * 1e-9 for i in range(400)]
    rows = spark.sparkContext.parallelize([("a", v) for v in values], 2).map(seen)
    df = spark.createDataFrame(rows, "k string, v double")
    found = grouped_percentiles(df, ["k"], "v", POINTS, "nearest", group_rows=0).first()
    assert [found[n] for n in POINTS] == [nearest(values, p) for p in POINTS.values()]
    assert read.value == 2 * len(values)
