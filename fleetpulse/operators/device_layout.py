"""A copy of the raw table in which the rows of one device are found without opening every file.

Rows lie along a curve within their day: two bits of the device's hash alternate with one of the time
of day. A file is a piece of the curve, so it spans few devices and a part of the day. One bounds row per file
tells which; a lookup reads the bounds, then only the files that can hold the device in its range. The
hash spreads devices evenly whatever their names are, and a device with a third of all rows is
split along its time.

Every run writes files and then bounds of its own number, and readers take the newest run of each day from the
bounds: files of a run that failed are never seen, and a reader that started before a run ends still has its files.
A day that a later run finds no rows for stays as it was. An empty table gives no bounds and every lookup is empty.
"""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import day_key, epoch_ms
from fleetpulse.operators.tables import in_time_range
from fleetpulse.session import hadoop_path

DEVICE_BITS, TIME_BITS = 14, 6
DAY_MS = 86_400_000
ROWS_PER_FILE = 2_000_000
BOUNDS = ("run long, day string, name string, rows long, first_slot int, last_slot int, "
          "first_time timestamp, last_time timestamp")


def device_slot(device):
    """The leading bits of a device's hash."""
    return F.shiftrightunsigned(F.xxhash64(device), 64 - DEVICE_BITS).cast("int")


def day_part(at):
    """Which of the equal parts of its day a time lies in."""
    return F.floor(F.pmod(epoch_ms(at), F.lit(DAY_MS)) * (1 << TIME_BITS) / DAY_MS).cast("int")


def curve(slot, part):
    """Both numbers' bits by turns from the top: two of the device, as days split the time already, then one of the time."""
    turns = sorted([((k // 2, 0), slot, DEVICE_BITS - 1 - k) for k in range(DEVICE_BITS)]
                   + [((k, 1), part, TIME_BITS - 1 - k) for k in range(TIME_BITS)], key=lambda turn: turn[0])
    place = F.lit(0)
    for height, (_, number, bit) in enumerate(reversed(turns)):
        place = place.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), height))
    return place


def _bounds_path(path):
    return f"{path}/bounds"


def _exists(spark, path):
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def file_bounds(spark, path):
    """The bounds rows of each day's newest run."""
    if not _exists(spark, _bounds_path(path)):
        return spark.createDataFrame([], BOUNDS)
    every = spark.read.schema(BOUNDS).parquet(_bounds_path(path))
    newest = every.groupBy("day").agg(F.max("run").alias("run"))
    return every.join(newest, ["day", "run"])


def _stored(spark, path, tags):
    shape = schema.with_tags(schema.RAW_TABLE, tags).add("device_slot", "integer").add("run", "long")
    return spark.read.schema(shape).option("basePath", f"{path}/rows")


def store_by_device(raw, path, tags=(), rows_per_file=ROWS_PER_FILE):
    """Write the days of ``raw`` along the curve; they replace those days for readers. Gives the run's number."""
    spark = raw.sparkSession
    run = 0
    if _exists(spark, _bounds_path(path)):
        run = spark.read.schema(BOUNDS).parquet(_bounds_path(path)).agg(F.max("run")).first()[0] + 1
    columns = schema.with_tags(schema.RAW_TABLE, tags).fieldNames()
    placed = raw.select(*columns, device_slot("device_id").alias("device_slot")).withColumns({
        "_place": curve(F.col("device_slot"), day_part("event_time")), "_origin": F.spark_partition_id()})
    order = ("day", "_place", "event_time")
    target = f"{path}/rows/run={run}"
    (placed.repartitionByRange(*order, "_origin").sortWithinPartitions(*order).drop("_place", "_origin")
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("day").parquet(target))
    if any(s.isDirectory() for s in _children(spark, target)):
        _bounds_of(_stored(spark, path, tags).parquet(target), run).write.mode("append").parquet(_bounds_path(path))
    return run


def _children(spark, path):
    fs, target = hadoop_path(spark, path)
    return fs.listStatus(target)


def _bounds_of(rows, run):
    name = F.regexp_extract("_metadata.file_path", "[^/]+$", 0)
    return rows.groupBy("day", name.alias("name")).agg(
        F.count("*").alias("rows"), F.min("device_slot").alias("first_slot"), F.max("device_slot").alias("last_slot"),
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"),
    ).select(F.lit(run).cast("long").alias("run"), "day", "name", "rows", "first_slot", "last_slot",
             "first_time", "last_time")


def files_of_device(spark, path, device_id, from_ms, to_ms):
    """The bounds rows of the files that can hold rows of a device in a half-open range."""
    slot = device_slot(F.lit(device_id))
    first, last = (F.timestamp_millis(F.lit(ms)) for ms in (from_ms, to_ms))
    return file_bounds(spark, path).where(
        F.col("day").between(day_key(first), day_key(F.timestamp_millis(F.lit(to_ms - 1))))
        & (F.col("first_slot") <= slot) & (F.col("last_slot") >= slot)
        & (F.col("first_time") < last) & (F.col("last_time") >= first))


def device_rows(spark, path, device_id, from_ms, to_ms, tags=()):
    """The raw rows of one device in a half-open range, in time order.

    The paths of the files to read come to the driver, as those of any scan do.
    """
    files = [f"{path}/rows/run={r.run}/day={r.day}/{r.name}"
             for r in files_of_device(spark, path, device_id, from_ms, to_ms).collect()]
    columns = schema.with_tags(schema.RAW_TABLE, tags).fieldNames()
    if not files:
        return spark.createDataFrame([], schema.with_tags(schema.RAW_TABLE, tags))
    rows = _stored(spark, path, tags).parquet(*files).where(
        (F.col("device_slot") == device_slot(F.lit(device_id))) & (F.col("device_id") == device_id))
    found = in_time_range(rows, "event_time", from_ms, to_ms).select(*columns)
    return found.orderBy("event_time", *[c for c in columns if c != "event_time"])
