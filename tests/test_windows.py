import random

import pytest
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators import sketches, windows
from tests.helpers import beat, beats, plan_of

T0 = 1_700_000_040_000  # a minute boundary


def aggregate(spark, rows, **more):
    return windows.window_aggregate(beats(spark, rows), **more)


MODES = [("exact", "exact"), ("approx", "exact"), ("sketch", "exact"), ("cells", "exact"),
         ("approx", "approx"), ("sketch", "approx"), ("cells", "approx")]


@pytest.mark.parametrize("quantiles, distinct", MODES)
def test_small_groups(spark, quantiles, distinct):
    """Random events of three windows against counts in plain Python."""
    rng = random.Random(12)
    rows = [beat(f"m{rng.randrange(8)}", at=T0 + rng.randrange(180_000), latency=rng.randrange(900) / 4) for _ in range(70)]
    found = aggregate(spark, rows, quantiles=quantiles, distinct=distinct).collect()
    expected = {}
    for device, _, _, at, latency, *_ in rows:
        expected.setdefault(at // 60_000, []).append((device, latency))
    assert len(found) == len(expected) == 3
    for row in found:
        inside = expected[int(row.window_start.timestamp()) // 60]
        assert row["count"] == len(inside) and row.distinct_count == len({d for d, _ in inside})
        assert row.avg_latency == pytest.approx(sum(v for _, v in inside) / len(inside))
        assert (row.window_end - row.window_start).total_seconds() == 60


@pytest.mark.parametrize("quantiles, distinct", MODES)
def test_uniform_thousand(spark, quantiles, distinct):
    rows = [beat(f"d{i}", at=T0 + i, latency=float(i)) for i in range(1, 1001)]
    row = aggregate(spark, rows, quantiles=quantiles, distinct=distinct).first()
    assert row["count"] == 1000 and row.avg_latency == pytest.approx(500.5, abs=1e-9)
    assert abs(row.p50_latency - 500) <= 5
    assert abs(row.p95_latency - 950) <= 10 and abs(row.p99_latency - 990) <= 10
    assert row.distinct_count == 1000 if distinct == "exact" else abs(row.distinct_count - 1000) < 30


def test_absent_text_and_numbers(spark):
    """Absent dimensions become '', and an absent device is the device ''."""
    rows = [beat(None, None, None, T0), beat("", None, None, T0)]
    row = aggregate(spark, rows).first()
    assert (row.region, row.status, row["count"], row.distinct_count) == ("", "", 2, 1)


def test_windows_are_epoch_aligned_and_half_open(spark):
    rows = [beat(at=T0 - 1), beat(at=T0), beat(at=T0 + 59_999), beat(at=T0 + 60_000)]
    found = aggregate(spark, rows).select(F.unix_millis("window_start"), "count").collect()
    assert sorted(tuple(r) for r in found) == [(T0 - 60_000, 1), (T0, 2), (T0 + 60_000, 1)]


def test_no_rows_no_windows(spark):
    assert aggregate(spark, []).count() == 0


def test_extra_dimension(spark):
    df = beats(spark, [beat(at=T0)] * 2).withColumn("device_model", F.lit("m1")).unionByName(
        beats(spark, [beat(at=T0)]).withColumn("device_model", F.lit(None).cast("string")))
    found = windows.window_aggregate(df, dims=(*schema.DIMENSIONS, "device_model"))
    assert sorted((r.device_model, r["count"]) for r in found.collect()) == [("", 1), ("m1", 2)]


def test_modes_are_checked(spark):
    with pytest.raises(ValueError):
        aggregate(spark, [beat()], quantiles="median")
    with pytest.raises(ValueError):
        aggregate(spark, [beat()], quantiles="exact", distinct="approx")


def test_a_hot_key_travels_as_counts(spark):
    """Half of all rows in one group and one device: folded before every exchange."""
    rng = random.Random(1)
    rows = [beat("hot", at=T0, latency=5.0)] * 3000 + [
        beat(f"d{rng.randrange(50)}", at=T0, latency=float(rng.randrange(100))) for _ in range(3000)]
    df = windows.window_aggregate(beats(spark, rows).repartition(6), quantiles="sketch", distinct="approx")
    assert df.first()["count"] == 6000
    plan = plan_of(df)
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


# --- mergeable sketches

def test_merged_state_equals_the_whole(spark):
    rows = [beat(f"d{i}", at=T0 + (i % 5) * 60_000, latency=float(i)) for i in range(1, 1001)]
    stored = windows.sketch_windows(beats(spark, rows))
    assert stored.count() == 5
    row = sketches.merge_sketch_rows(stored, ["region"]).first()
    assert row["count"] == 1000 and row.avg_latency == pytest.approx(500.5, abs=1e-9)
    assert abs(row.distinct_count - 1000) < 30
    assert abs(row.p50_latency - 500) <= 5
    assert abs(row.p95_latency - 950) <= 10 and abs(row.p99_latency - 990) <= 10


def test_same_devices_in_many_windows_count_once(spark):
    rows = [beat(f"d{i % 40}", at=T0 + i * 10_000) for i in range(400)]
    merged = sketches.merge_sketch_rows(windows.sketch_windows(beats(spark, rows)))
    assert merged.first().distinct_count == 40


@pytest.mark.parametrize("how", [{}, {"quantiles": "approx"}, {"quantiles": "sketch"},
                                 {"quantiles": "sketch", "distinct": "approx"}])
def test_absent_numbers_count_as_zero_in_every_mode(spark, how):
    rows = [beat("a", latency=None), beat("a", latency=None), beat(None, at=None, latency=3.0), beat("", at=0, latency=3.0)]
    found = {r.window_start.timestamp() > 0: r for r in windows.window_aggregate(beats(spark, rows), **how).collect()}
    assert (found[True]["count"], found[True].distinct_count, found[True].avg_latency, found[True].p50_latency) == (2, 1, 0.0, 0.0)
    assert (found[False]["count"], found[False].distinct_count, found[False].p99_latency) == (2, 1, 3.0)
