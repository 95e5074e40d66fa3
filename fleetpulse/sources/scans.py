"""Readers: topics, message files and the two stored tables, bounded or as streams."""

import json

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.session import is_directory


def kafka_options(brokers, topic, start="latest"):
    """``start``: latest or earliest; a stream with a checkpoint goes on where it stopped."""
    return {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": start}


def topic_stream(spark, brokers, topic, start="latest", **more):
    """Unbounded messages of one topic. Needs the Kafka connector of the Spark release."""
    return (spark.readStream.format("kafka").options(**kafka_options(brokers, topic, start))
            .options(**more).load())


def topic_parts(spark, brokers, topic, partitions, start="latest", **more):
    """A topic as one stream for each of its partitions, so that each gets a watermark of its own."""
    plain = {k: v for k, v in kafka_options(brokers, topic, start).items() if k != "subscribe"}
    return [spark.readStream.format("kafka").options(**plain, assign=json.dumps({topic: [number]}))
            .options(**more).load() for number in range(partitions)]


def topic_batch(spark, brokers, topic, **more):
    """All messages a topic holds now, oldest first."""
    return (spark.read.format("kafka").options(**kafka_options(brokers, topic, "earliest"))
            .options(**more).load())


def file_stream(spark, path, max_files=None):
    """Message files of a folder, one JSON document per line, as an unbounded source."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def file_parts(spark, paths, max_files=None):
    """Message folders as one stream each, such as the partitions of a source copied to files."""
    return [file_stream(spark, path, max_files) for path in paths]


def file_batch(spark, path):
    return spark.read.text(path)


def peek(messages, n=5):
    """The first ``n`` messages: a look, not a result."""
    return messages.limit(n)


def _filled_tags(rows, tags):
    """A tag that a file does not have yet is the empty text."""
    return rows.withColumns({tag: F.coalesce(tag, F.lit("")) for tag in tags}) if tags else rows


def raw_table(spark, path, tags=()):
    """Heartbeats of all loads; a load is one batch's or micro-batch's folder of a day."""
    shape = schema.with_tags(schema.RAW_TABLE, tags).add("load", "string")
    return _filled_tags(spark.read.schema(shape).parquet(path).drop("load"), tags)


def aggregate_table(spark, path, tags=()):
    return _filled_tags(spark.read.schema(schema.with_tags(schema.AGGREGATE_TABLE, tags)).parquet(path), tags)


def stored_tags(spark, path, shape=schema.RAW_TABLE):
    """The tags that any file of a table has, by name: reads the files' footers, not their rows."""
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    return tuple(sorted(f.name for f in found.fields
                        if f.name not in (*shape.fieldNames(), "load") and f.dataType.simpleString() == "string"))


def exported_rows(spark, path, shape, form="json"):
    """Result files of ``stores.export_rows`` with the columns of ``shape``."""
    reader = spark.read.schema(shape)
    if form in ("csv", "tsv"):
        return reader.option("header", "true").option("sep", "," if form == "csv" else "\t").csv(path)
    return reader.format(form).load(path)


def parquet_stream(spark, path, shape):
    """A parquet dataset as a stream; a dataset of one file is met through its folder."""
    reader = spark.readStream.schema(shape)
    if is_directory(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def request_rows(spark, path):
    """Request envelopes stored as JSON lines of (request_id, kind, body)."""
    return spark.read.schema(schema.REQUEST).json(path)


def request_stream(spark, path):
    return spark.readStream.schema(schema.REQUEST).json(path)


def with_kind(messages, kind, id_column):
    """Bare bodies of one endpoint as request rows."""
    return messages.select(F.col(id_column).cast("string").alias("request_id"),
                           F.lit(kind).alias("kind"), F.col("value").cast("string").alias("body"))
