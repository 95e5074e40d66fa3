"""Writers: day-partitioned tables, JDBC copies, topics and result files."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.functions import number_or_zero
from fleetpulse.operators.decode import encode_heartbeats
from fleetpulse.operators.tables import (
    aggregate_rows, latest_version, lay_out_by_day, lay_out_closed_windows, raw_rows,
)
from fleetpulse.session import hadoop_path, saved
from fleetpulse.sources.scans import aggregate_table

# Rows per insert statement of the two tables.
RAW_JDBC_BATCH = 1000
AGGREGATE_JDBC_BATCH = 500


def as_messages(heartbeats, tags=()):
    """Key and value columns as a topic takes them; no rows give no messages."""
    return heartbeats.select(*encode_heartbeats(tags))


def kafka_options(brokers, topic):
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.acks": "1"}


def topic_rows(heartbeats, tags=()):
    """Messages with the event time as a header: the topic sink stamps its own message time."""
    time_header = F.struct(F.lit("timestamp_ms").alias("key"),
                           number_or_zero(F.col("timestamp_ms")).cast("string").cast("binary").alias("value"))
    return heartbeats.select(*encode_heartbeats(tags), F.array(time_header).alias("headers"))


def publish_batch(heartbeats, brokers, topic, tags=()):
    (topic_rows(heartbeats, tags).write.format("kafka")
     .options(**kafka_options(brokers, topic)).save())


def publish_stream(heartbeats, brokers, topic, checkpoint, tags=()):
    return (topic_rows(heartbeats, tags).writeStream.format("kafka")
            .options(**kafka_options(brokers, topic))
            .option("checkpointLocation", checkpoint).start())


def append_raw(heartbeats, path, tags=(), in_time_order=False):
    """Backfill of the raw table from a batch of heartbeats."""
    laid_out = lay_out_by_day(raw_rows(heartbeats, tags), schema.RAW_ORDER, in_time_order)
    _write_load(laid_out, path, f"batch-{uuid.uuid4().hex}")


def write_stream_load(raw, path, source, batch_id):
    """A micro-batch of raw rows. Written again after a failure, it replaces itself."""
    _write_load(raw, path, f"{source}.{batch_id:012d}")


def _write_load(raw, path, load):
    """A load of the raw table; its files can be skipped by device."""
    (raw.withColumn("load", F.lit(load)).write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#device_id", "true")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day", "load").parquet(path))


def append_aggregates(windows, path, batch_id=0, ingested_at=None, key=schema.AGGREGATE_KEY):
    """Append a new version of each window; readers keep the newest.

    The rows are saved first: a range split samples its input, which would run the windows twice.
    """
    rows = saved(aggregate_rows(windows, batch_id, ingested_at), "aggregate-rows")
    laid_out = lay_out_by_day(rows, key)
    laid_out.write.mode("append").partitionBy("day").parquet(path)


def append_closed_windows(windows, path, batch_id, key=schema.AGGREGATE_KEY):
    """The same append from inside a micro-batch."""
    laid_out = lay_out_closed_windows(aggregate_rows(windows, batch_id), key)
    laid_out.write.mode("append").partitionBy("day").parquet(path)


def append_jdbc(rows, url, table, driver, batch_rows):
    (rows.write.format("jdbc").mode("append")
     .options(url=url, dbtable=table, driver=driver, batchsize=batch_rows).save())


def append_raw_jdbc(raw, url, driver, table="heartbeats"):
    """Rows of the raw table into a database; the day is the folder's, not a column there."""
    append_jdbc(raw.drop("day"), url, table, driver, RAW_JDBC_BATCH)


def append_aggregates_jdbc(windows, url, driver, table="heartbeat_aggregates"):
    """Windows into a database that stamps the insert time and keeps the newest per key."""
    append_jdbc(windows, url, table, driver, AGGREGATE_JDBC_BATCH)


def _days(table, first_day, last_day):
    if first_day:
        table = table.where(F.col("day") >= first_day)
    if last_day:
        table = table.where(F.col("day") <= last_day)
    return table


def _replace_days(rows, target):
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(target))


def compact_days(aggregates, target, first_day=None, last_day=None, key=schema.AGGREGATE_KEY):
    """Write the collapsed rows of whole days below ``target``, replacing those days there.

    ``target`` is another folder than the one ``aggregates`` reads, so a task
    that runs again still finds its input. Days outside the range stay as they are.
    """
    collapsed = latest_version(_days(aggregates, first_day, last_day), key)
    _replace_days(lay_out_by_day(collapsed, key), target)


def _data_files(spark, path):
    """path, length, modificationTime and day of each file of a table, from the listing: none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length", "modificationTime",
                        F.regexp_extract("path", "/day=([^/]+)/", 1).alias("day"))


def compact_new_days(spark, source, target, mark, key=schema.AGGREGATE_KEY, tags=()):
    """Compact the days of ``source`` with files that no earlier run has seen; gives those days.

    ``mark`` is a folder that lists the files compacted so far. A day with a new file is read in full, as any
    of its windows may have a newer version; other days are not read. A run that fails before its
    mark is written is done again as a whole.
    """
    files = saved(_data_files(spark, source), "files")
    fresh = files
    if _exists(spark, mark):
        fresh = files.join(spark.read.schema(files.schema).parquet(mark), files.columns, "left_anti")
    days = sorted(r.day for r in fresh.select("day").distinct().collect())
    if days:
        table = aggregate_table(spark, source, tags).where(F.col("day").isin(days))
        compact_days(table, target, key=key)
        files.where(F.col("day").isin(days)).write.mode("append").parquet(mark)
    return days


def _exists(spark, path):
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def sort_raw_days(raw, target, first_day=None, last_day=None):
    """Merge the small unsorted files a stream leaves into sorted ones below ``target``."""
    days = _days(raw, first_day, last_day)
    _replace_days(lay_out_by_day(days, schema.RAW_ORDER), target)


def _folders(fs, path, prefix):
    return [status.getPath() for status in fs.listStatus(path)
            if status.isDirectory() and status.getPath().getName().startswith(prefix)]


def merge_raw_days(spark, path, first_day=None, last_day=None, tags=()):
    """Merge the loads of each day of the raw table into one sorted load, in place; gives the days.

    The newest load of each stream stays as it is, since that one may still be written again.
    The merged rows wait in a hidden folder beside a list of the loads they replace, so that
    ``finish_merges`` can complete a switch that was interrupted; it runs first here, too. Run
    one merge at a time: a read planned during the switch fails or misses the day.
    """
    finish_merges(spark, path)
    fs, root = hadoop_path(spark, path)
    loads = {day: _folders(fs, day, "load=") for day in _folders(fs, root, "day=")
             if (first_day or "") <= day.getName()[4:] <= (last_day or "9")}
    every = {load.getName() for found in loads.values() for load in found}
    newest = set({name.rpartition(".")[0]: name for name in sorted(every) if "." in name}.values())
    loads = {day.getName()[4:]: [str(load) for load in found if load.getName() not in newest]
             for day, found in loads.items()}
    loads = {day: found for day, found in loads.items() if len(found) > 1}
    if loads:
        replaced = [load for found in loads.values() for load in found]
        shape = schema.with_tags(schema.RAW_TABLE, tags).add("load", "string")
        rows = spark.read.schema(shape).option("basePath", str(root)).parquet(*replaced).drop("load")
        merge = uuid.uuid4().hex
        (lay_out_by_day(rows, schema.RAW_ORDER).withColumn("load", F.lit(f"merged-{merge}"))
         .write.partitionBy("day", "load").parquet(f"{path}/_merges/{merge}/rows"))
        spark.createDataFrame([(load,) for load in replaced], "load string").coalesce(1).write.text(
            f"{path}/_merges/{merge}/replaced")
        finish_merges(spark, path)
    return sorted(loads)


def finish_merges(spark, path):
    """Complete each merge that has listed what it replaces, discard the others."""
    fs, root = hadoop_path(spark, f"{path}/_merges")
    for merge in _folders(fs, root, "") if fs.exists(root) else ():
        if fs.exists(hadoop_path(spark, f"{merge}/replaced/_SUCCESS")[1]):
            for row in spark.read.text(f"{merge}/replaced").toLocalIterator():
                fs.delete(hadoop_path(spark, row.value)[1], True)
            for day in _folders(fs, hadoop_path(spark, f"{merge}/rows")[1], "day="):
                target = hadoop_path(spark, f"{path}/{day.getName()}")[1]
                fs.mkdirs(target)
                for load in _folders(fs, day, "load="):
                    if not fs.rename(load, target):
                        raise OSError(f"could not move {load} to {target}")
        fs.delete(merge, True)


def drop_expired_days(spark, path, as_of_ms, keep_days):
    """Delete day folders of which every row has passed its keeping time; gives their days."""
    fs, root = hadoop_path(spark, path)
    cutoff = datetime.fromtimestamp(as_of_ms / 1000 - keep_days * 86_400, timezone.utc)
    cutoff = cutoff.strftime("%Y%m%d")
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("day=") and name[4:] < cutoff:
            fs.delete(status.getPath(), True)
            gone.append(name[4:])
    return sorted(gone)


def export_rows(rows, path, form="json"):
    """Result rows as files: json, csv, tsv or parquet."""
    writer = rows.write.mode("overwrite")
    if form == "json":
        writer.option("ignoreNullFields", "false").json(path)
    elif form in ("csv", "tsv"):
        writer.option("header", "true").option("sep", "," if form == "csv" else "\t").csv(path)
    elif form == "parquet":
        writer.parquet(path)
    else:
        raise ValueError("form must be json, csv, tsv or parquet")
