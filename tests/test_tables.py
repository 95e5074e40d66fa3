import os

import pytest
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import clock_text, day_key, round_half_up, whole_second
from fleetpulse.operators import tables, windows
from fleetpulse.sinks import stores
from fleetpulse.sources import events, scans
from tests.helpers import beat, beats, plan_of, rows_of

DAY_MS = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 UTC


def hourly(n, device="d"):
    return [beat(f"{device}{i}", at=T0 + i * 3_600_000, latency=float(i)) for i in range(n)]


def version(spark, rows):
    names = "window_start_ms long, region string, status string, count long, ingested_ms long, batch_id long"
    return spark.createDataFrame(rows, names).select(
        F.timestamp_millis("window_start_ms").alias("window_start"), "region", "status", "count",
        F.timestamp_millis("ingested_ms").alias("ingested_at"), "batch_id")


def test_raw_row_shape(spark):
    row = tables.raw_rows(beats(spark, [beat(None, None, "ok", T0, None, 0.1, None)])).first()
    assert (row.device_id, row.region, row.status, row.latency_ms, row.mem_usage) == ("", "", "ok", 0.0, 0.0)
    assert row.cpu_usage != 0.1 and abs(row.cpu_usage - 0.1) < 1e-7
    assert row.day == "20240101"


def test_stored_schemas(spark):
    raw = tables.raw_rows(beats(spark, [beat()]))
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in schema.RAW_TABLE]
    aggregates = tables.aggregate_rows(windows.window_aggregate(beats(spark, [beat()])), 3)
    assert [(f.name, f.dataType) for f in aggregates.schema] == [
        (f.name, f.dataType) for f in schema.AGGREGATE_TABLE]


def test_newest_version_wins_and_batch_breaks_ties(spark):
    rows = [(T0, "r", "ok", 1, 1000, 0), (T0, "r", "ok", 2, 2000, 1), (T0, "r", "ok", 3, 2000, 2),
            (T0, "r", "ok", 9, 1500, 7), (T0, "r", "warn", 5, 1000, 0)]
    assert rows_of(tables.latest_version(version(spark, rows)), "status", "count") == [("ok", 3), ("warn", 5)]


def test_a_third_of_the_rows_are_copies_of_one_key(spark):
    rows = [(T0, "r", "ok", i, i * 1000, 0) for i in range(500)] + [
        (T0 + i * 60_000, "r", "ok", i, 1, 0) for i in range(1, 1000)]
    df = tables.latest_version(version(spark, rows).repartition(6))
    assert df.count() == 1000 and df.where(F.col("window_start") == F.timestamp_millis(F.lit(T0))).first()["count"] == 499
    plan = plan_of(df)
    assert "partial_max_by" in plan and "SortAggregate" not in plan


def test_collapse_reads_only_the_columns_in_use(spark, folder):
    stores.append_aggregates(windows.window_aggregate(beats(spark, hourly(5))), f"{folder}/a")
    df = tables.latest_version(scans.aggregate_table(spark, f"{folder}/a"))
    plan = plan_of(df.groupBy("region").agg(F.sum("count")))
    assert "p50_latency" not in plan and "window_end" not in plan


def test_any_batch_keeps_its_order_and_an_absent_one_is_zero(spark):
    rows = [(T0, "r", "ok", 1, 1000, 2 ** 29), (T0, "r", "ok", 2, 1000, 2 ** 62),
            (T0, "s", "ok", 3, 1000, None), (T0, "s", "ok", 4, 1000, 1), (T0, "s", "ok", 5, 0, 2 ** 62)]
    found = tables.latest_version(version(spark, rows)).collect()
    assert sorted((r.region, r["count"]) for r in found) == [("r", 2), ("s", 4)]


def test_filter_on_key_reaches_the_scan_below_the_collapse(spark, folder):
    version(spark, [(T0, "r", "ok", 1, 1000, 0), (T0, "s", "ok", 1, 1000, 0)]).write.parquet(f"{folder}/v")
    df = tables.latest_version(spark.read.parquet(f"{folder}/v")).where("region = 'r'")
    assert df.count() == 1 and "EqualTo(region,r)" in plan_of(df)


def test_layout_is_sorted_and_split_by_day(spark, folder):
    stores.append_raw(beats(spark, hourly(72)).repartition(5), f"{folder}/raw")
    assert sorted(d for d in os.listdir(f"{folder}/raw") if d.startswith("day=")) == [
        "day=20240101", "day=20240102", "day=20240103"]
    stored = scans.raw_table(spark, f"{folder}/raw")
    assert stored.count() == 72
    for name in stored.inputFiles():
        times = [r.event_time for r in spark.read.parquet(name).collect()]
        assert times == sorted(times)


def test_input_in_time_order_is_not_shuffled(spark, folder):
    rows = tables.raw_rows(beats(spark, hourly(48)).coalesce(1))
    assert "Exchange" not in plan_of(tables.lay_out_by_day(rows, schema.RAW_ORDER, in_time_order=True))
    stores.append_raw(beats(spark, hourly(48)), f"{folder}/raw", in_time_order=True)
    assert scans.raw_table(spark, f"{folder}/raw").count() == 48


def test_windows_from_the_stored_raw_table(spark, folder):
    df = beats(spark, hourly(30))
    stores.append_raw(df, f"{folder}/raw")
    stored = windows.window_aggregate(scans.raw_table(spark, f"{folder}/raw"), 7200)
    direct = windows.window_aggregate(df, 7200)
    assert rows_of(stored, *direct.columns) == rows_of(direct, *direct.columns)


def test_equal_rows_are_spread_over_tasks(spark):
    df = beats(spark, [beat(None, None, None, 0, 0.0)] * 4000).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = tables.lay_out_by_day(tables.raw_rows(df), schema.RAW_ORDER)
        sizes = [r[1] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 3000


def test_range_read_prunes_folders(spark, folder):
    stores.append_raw(beats(spark, hourly(72)), f"{folder}/raw")
    df = tables.in_time_range(scans.raw_table(spark, f"{folder}/raw"), "event_time",
                              T0 + DAY_MS, T0 + 2 * DAY_MS)
    assert df.count() == 24
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(event_time" in plan
    assert "(day#" in plan and ">= 20240102" in plan and "<= 20240102" in plan


def test_compaction_keeps_one_row_per_key_and_other_days(spark, folder):
    aggregates = windows.window_aggregate(beats(spark, hourly(48)), 3600)
    for batch in range(3):
        more = aggregates.withColumn("count", F.col("count") + batch)
        stores.append_aggregates(more, f"{folder}/all", batch, F.timestamp_millis(F.lit(T0)))
    stored = scans.aggregate_table(spark, f"{folder}/all")
    assert stored.count() == 144
    stores.compact_days(stored, f"{folder}/compact")
    stores.compact_days(stored.where("batch_id = 0"), f"{folder}/compact", "20240102", "20240102")
    compact = scans.aggregate_table(spark, f"{folder}/compact")
    assert rows_of(compact.groupBy("day", "count").agg(F.count("*").alias("n")), "day", "count", "n") == [
        ("20240101", 3, 24), ("20240102", 1, 24)]


def test_sorted_raw_days(spark, folder):
    tables.raw_rows(beats(spark, hourly(48)).repartition(6)).write.partitionBy("day").parquet(f"{folder}/raw")
    stores.sort_raw_days(scans.raw_table(spark, f"{folder}/raw"), f"{folder}/sorted")
    assert scans.raw_table(spark, f"{folder}/sorted").count() == 48


@pytest.mark.parametrize("column, keep", [("event_time", 7), ("window_start", 90)])
def test_retention_edge(spark, column, keep):
    as_of = T0 + keep * DAY_MS
    df = spark.createDataFrame([(T0 - 1,), (T0,), (T0 + 999,), (T0 + 1000,)], "ms long").select(
        "ms", F.timestamp_millis("ms").alias(column))
    kept = tables.unexpired(df, column, as_of, keep)
    assert rows_of(kept, "ms") == [(T0 + 1000,)]


def test_drop_expired_days(spark, folder):
    stores.append_raw(beats(spark, hourly(24 * 10)), f"{folder}/raw")
    gone = stores.drop_expired_days(spark, f"{folder}/raw", T0 + 9 * DAY_MS + 5, schema.RAW_RETENTION_DAYS)
    assert gone == ["20240101", "20240102"]
    left = scans.raw_table(spark, f"{folder}/raw")
    assert left.count() == 24 * 8
    assert tables.unexpired_raw(left, T0 + 9 * DAY_MS + 5).count() == 24 * 7 + 23


@pytest.mark.parametrize("form", ["json", "csv", "tsv", "parquet"])
def test_export(spark, folder, form):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n long, s string")
    stores.export_rows(df, f"{folder}/out", form)
    if form == "json":
        back = spark.read.schema(df.schema).json(f"{folder}/out")
    elif form == "parquet":
        back = spark.read.parquet(f"{folder}/out")
    else:
        back = spark.read.schema(df.schema).csv(f"{folder}/out", header=True, sep="," if form == "csv" else "\t")
    assert sorted(back.collect()) == sorted(df.collect())


def test_export_form_is_checked(spark, folder):
    with pytest.raises(ValueError):
        stores.export_rows(spark.range(1), folder, "xml")


def test_scalars(spark):
    row = spark.range(1).select(
        day_key(F.timestamp_millis(F.lit(T0 - 1))).alias("day"),
        day_key(F.timestamp_millis(F.lit(-1))).alias("before_epoch"),
        clock_text(F.timestamp_millis(F.lit(T0 + 3_723_000))).alias("clock"),
        F.unix_millis(whole_second(F.timestamp_millis(F.lit(T0 + 999)))).alias("second"),
        round_half_up(F.lit(12.35)).alias("up"),
        round_half_up(F.lit(12.35 - 2e-15)).alias("noise"),
        round_half_up(F.lit(0.05)).alias("half")).first()
    assert tuple(row) == ("20231231", "19691231", "01:02:03", T0, 12.4, 12.4, 0.1)


def test_event_time_bounds_reach_the_scan(spark, sf_dir):
    df = events.heartbeats(spark, sf_dir, T0 + DAY_MS, T0 + 2 * DAY_MS)
    plan = plan_of(df.select("device_id"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "props" not in plan.split("ReadSchema")[1]


def test_a_micro_batch_written_again_replaces_itself(spark, folder):
    raw = tables.raw_rows(beats(spark, hourly(30)))
    for batch_id in (0, 1, 1):
        stores.write_stream_load(raw, f"{folder}/raw", "source", batch_id)
    assert scans.raw_table(spark, f"{folder}/raw").count() == 60


def test_merge_keeps_the_newest_load_of_a_stream(spark, folder):
    raw = tables.raw_rows(beats(spark, hourly(24)))
    for batch_id in (0, 1, 2):
        stores.write_stream_load(raw, f"{folder}/raw", "source", batch_id)
    before = sorted(scans.raw_table(spark, f"{folder}/raw").collect())
    assert len(stores.merge_raw_days(spark, f"{folder}/raw")) == 1
    assert sorted(scans.raw_table(spark, f"{folder}/raw").collect()) == before
    stores.write_stream_load(raw, f"{folder}/raw", "source", 2)
    assert scans.raw_table(spark, f"{folder}/raw").count() == 72
    assert stores.merge_raw_days(spark, f"{folder}/raw") == []


def test_interrupted_merge(spark, folder, monkeypatch):
    path = f"{folder}/raw"
    for _ in range(2):
        stores.append_raw(beats(spark, hourly(24)), path)
    finish, calls = stores.finish_merges, []
    monkeypatch.setattr(stores, "finish_merges", lambda *a: calls.append(a) or len(calls) > 1)
    stores.merge_raw_days(spark, path)
    assert scans.raw_table(spark, path).count() == 48
    monkeypatch.setattr(stores, "finish_merges", finish)
    stores.finish_merges(spark, path)
    stores.finish_merges(spark, path)
    assert scans.raw_table(spark, path).count() == 48
