import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import device_layout as layout
from fleetpulse.operators import tables
from fleetpulse.plans import reads
from tests.helpers import beat, beats, rows_of

DAY_MS = 86_400_000
START = 1_700_006_400_000  # a midnight
DEVICES = [f"unit-{k}" for k in range(40)]


def many(spark, days=2, hot=400):
    """Forty devices every half hour; one of them holds many rows of the first day."""
    rows = [beat(d, at=START + day * DAY_MS + k * 1_800_000 + n, latency=float(n))
            for day in range(days) for k in range(48) for n, d in enumerate(DEVICES)]
    rows += [beat("unit-7", at=START + k * 200_000, latency=5.0) for k in range(hot)]
    return tables.raw_rows(beats(spark, rows))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("by-device"))
    raw = many(spark)
    layout.store_by_device(raw, path, rows_per_file=100)
    return raw, path


def test_curve_alternates_bits_from_the_top(spark):
    bits = spark.range(1).select(
        layout.curve(F.lit(1 << layout.DEVICE_BITS - 1), F.lit(0)).alias("device"),
        layout.curve(F.lit(0), F.lit(1 << layout.TIME_BITS - 1)).alias("time"),
        layout.curve(F.lit(1), F.lit(0)).alias("last"),
        layout.curve(F.lit((1 << layout.DEVICE_BITS) - 1), F.lit((1 << layout.TIME_BITS) - 1)).alias("all")).first()
    top = layout.DEVICE_BITS + layout.TIME_BITS - 1
    assert (bits.device, bits.time, bits.last, bits.all) == (1 << top, 1 << top - 2, 1, (1 << top + 1) - 1)


@pytest.mark.parametrize("device", ["unit-7", "unit-31", "nobody", ""])
@pytest.mark.parametrize("span", [(START, START + 2 * DAY_MS), (START + 3_600_000, START + 7_200_000),
                                  (START + DAY_MS, START + DAY_MS + 1), (1, 2)])
def test_lookup_equals_the_scan(spark, stored, device, span):
    raw, path = stored
    found = layout.device_rows(spark, path, device, *span)
    expected = reads.device_history(raw, device, *span)
    assert found.columns == expected.columns and found.collect() == expected.collect()


def test_lookup_reads_few_files(spark, stored):
    raw, path = stored
    bounds = layout.file_bounds(spark, path).collect()
    assert sum(r.rows for r in bounds) == raw.count() and max(r.rows for r in bounds) <= 100
    slots = raw.select("device_id", layout.device_slot("device_id").alias("slot")).distinct().collect()
    read = {r.device_id: sum(b.first_slot <= r.slot <= b.last_slot for b in bounds) for r in slots}
    assert read["unit-7"] == layout.files_of_device(spark, path, "unit-7", START, START + 2 * DAY_MS).count()
    assert sum(read.values()) <= 0.25 * len(bounds) * len(DEVICES) and max(read.values()) <= 0.5 * len(bounds)
    hour = layout.files_of_device(spark, path, "unit-7", START, START + 3_600_000).count()
    assert hour <= 4


def test_time_order_alone_has_every_device_in_every_file(spark, stored):
    """What the curve is measured against: files of the same size in time order."""
    raw, _ = stored
    rows = raw.orderBy("event_time", "region", "device_id").collect()
    files = [{r.device_id for r in rows[k:k + 100]} for k in range(0, len(rows), 100)]
    assert sum(len(f) for f in files) > 0.9 * len(files) * len(DEVICES)


def test_a_run_replaces_its_days_only_when_it_is_complete(spark, folder):
    raw = many(spark, hot=0)
    assert layout.file_bounds(spark, folder).count() == 0
    assert layout.device_rows(spark, folder, "unit-1", START, START + DAY_MS).count() == 0
    layout.store_by_device(raw, folder)
    layout.store_by_device(raw.where("event_time < timestamp_millis(0)"), folder)
    second = raw.where(F.col("day") == "20231116").unionByName(raw.where(F.col("day") == "20231116"))
    layout.store_by_device(second, folder)
    orphan = f"{folder}/rows/run=9/day=20231115"
    raw.drop("day").withColumn("device_slot", layout.device_slot("device_id")).write.parquet(orphan)
    found = layout.device_rows(spark, folder, "unit-1", START, START + 2 * DAY_MS)
    assert rows_of(found.groupBy("day").count(), "day", "count") == [("20231115", 48), ("20231116", 96)]


def test_tags_and_hot_rows_of_one_instant(spark, folder):
    raw = tables.raw_rows(beats(spark, [beat("unit-1", at=START)] * 500)).withColumn("model", F.lit("m1"))
    layout.store_by_device(raw, folder, ("model",), rows_per_file=50)
    found = layout.device_rows(spark, folder, "unit-1", START, START + 1, ("model",))
    assert rows_of(found.groupBy("model").count(), "model", "count") == [("m1", 500)]
    assert layout.file_bounds(spark, folder).count() >= 10
