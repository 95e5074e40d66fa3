"""The stream job: one message source, a raw copy and closed windows as independent queries."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators.decode import decode_heartbeats
from fleetpulse.operators.envelopes import accepted_events, classify_requests, observe_counters
from fleetpulse.operators.tables import raw_rows
from fleetpulse.operators.validate import accepted
from fleetpulse.operators.windows import window_aggregate, with_event_time, with_watermark
from fleetpulse.session import use_parts_policy, use_stream_settings
from fleetpulse.sinks import stores


@dataclass(frozen=True)
class StreamSettings:
    window_seconds: int = schema.WINDOW_SECONDS
    out_of_order_seconds: int = schema.OUT_OF_ORDER_SECONDS
    dims: tuple = schema.DIMENSIONS
    distinct: str = "exact"
    # an epoch-ms number or column to drop invalid rows by; off, as ingest has checked them
    validate_now_ms: object = None
    trigger: str = "30 seconds"
    # of several parts: the watermark of the slowest ("min") or of the newest ("max")
    parts_policy: str = "min"
    # a part's watermark follows the clock at this distance, where its events do not; off
    idle_seconds: int = None


def heartbeats_of(messages, settings):
    beats = decode_heartbeats(messages, tags=schema.extra_tags(settings.dims))
    if settings.validate_now_ms is not None:
        beats = accepted(beats, settings.validate_now_ms)
    return beats


def clock_markers(spark, idle_seconds):
    """One row a second with the time that the clock showed ``idle_seconds`` ago."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.select((F.col("timestamp") - F.make_dt_interval(secs=F.lit(idle_seconds))).alias("event_time"),
                        F.lit(True).alias("is_marker"))


def timed_part(beats, settings):
    """Heartbeats of one part under the part's own watermark.

    With ``idle_seconds`` markers of the clock run through the watermark beside the events and end
    behind it: a part without events keeps only that distance from the clock and no window waits for it
    longer. An event that arrives later than ``idle_seconds`` plus the bound after its time may then be late, so
    leave this off where old messages are read again.
    """
    if settings.idle_seconds is None:
        return with_watermark(beats, settings.out_of_order_seconds)
    marked = with_event_time(beats).withColumn("is_marker", F.lit(False)).unionByName(
        clock_markers(beats.sparkSession, settings.idle_seconds), allowMissingColumns=True)
    timed = marked.withWatermark("event_time", f"{settings.out_of_order_seconds} seconds")
    # a condition on the event time stays above the watermark, so the markers pass through that
    is_event = F.when(F.col("is_marker"), F.lit(False)).otherwise(F.unix_millis("event_time").isNotNull())
    return timed.where(is_event).drop("is_marker")


def closed_windows(messages, settings=StreamSettings()):
    """Each window once, when the watermark passes its end; rows later than that are dropped.

    ``messages`` may be a list of parts, such as the partitions of a topic: each has a watermark of its
    own, and windows wait for the slowest one (``parts_policy``). After a start the watermark stays where
    it was until each part has sent something.
    """
    parts = messages if isinstance(messages, (list, tuple)) else [messages]
    timed = [timed_part(heartbeats_of(part, settings), settings) for part in parts]
    return window_aggregate(reduce(lambda a, b: a.unionByName(b), timed), settings.window_seconds, settings.dims,
                            distinct=settings.distinct)


def _triggered(writer, settings, live):
    if live:
        return writer.trigger(processingTime=settings.trigger)
    return writer.trigger(availableNow=True)


def start_raw_copy(messages, path, checkpoint, settings=StreamSettings(), live=True):
    """Append every heartbeat, late ones included, exactly once.

    Each micro-batch is a load of its own, named by the query's lasting id and its number, so
    that a batch that is run again replaces itself. The table is plain Parquet folders:
    backfills, expiry and merges work on it while the stream goes on.
    """
    rows = raw_rows(heartbeats_of(messages, settings), schema.extra_tags(settings.dims))

    def write(batch, batch_id):
        source = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        stores.write_stream_load(batch, path, source, batch_id)

    writer = (rows.writeStream.outputMode("append").foreachBatch(write)
              .option("checkpointLocation", checkpoint).queryName("raw_copy"))
    return _triggered(writer, settings, live).start()


def start_windows(messages, path, checkpoint, settings=StreamSettings(), live=True):
    """Append closed windows, each micro-batch as one version; a replayed batch adds
    copies that ``latest_version`` collapses on read. ``messages`` may be a list of parts."""
    key = ("window_start", *settings.dims)
    windows = closed_windows(messages, settings)
    use_parts_policy(windows.sparkSession, settings.parts_policy)

    def write(windows, batch_id):
        stores.append_closed_windows(windows, path, batch_id, key)

    writer = (windows.writeStream.outputMode("append")
              .foreachBatch(write).option("checkpointLocation", checkpoint)
              .queryName("windows"))
    return _triggered(writer, settings, live).start()


def start_raw_jdbc(messages, url, driver, checkpoint, settings=StreamSettings(), live=True):
    """Every heartbeat into a database table, at least once."""
    rows = raw_rows(heartbeats_of(messages, settings), schema.extra_tags(settings.dims))
    writer = (rows.writeStream.outputMode("append")
              .foreachBatch(lambda batch, _: stores.append_raw_jdbc(batch, url, driver))
              .option("checkpointLocation", checkpoint).queryName("raw_jdbc"))
    return _triggered(writer, settings, live).start()


def start_windows_jdbc(messages, url, driver, checkpoint, settings=StreamSettings(), live=True):
    """Closed windows into a database table, at least once."""
    windows = closed_windows(messages, settings)
    use_parts_policy(windows.sparkSession, settings.parts_policy)
    writer = (windows.writeStream.outputMode("append")
              .foreachBatch(lambda batch, _: stores.append_aggregates_jdbc(batch, url, driver))
              .option("checkpointLocation", checkpoint).queryName("windows_jdbc"))
    return _triggered(writer, settings, live).start()


def start_pipeline(spark, open_source, root, settings=StreamSettings(), live=True):
    """Start both queries below ``root``; losing one leaves the other running.

    ``open_source`` gives a fresh streaming DataFrame of messages for each.
    """
    use_stream_settings(spark, live)
    return {
        "raw": start_raw_copy(open_source(), f"{root}/heartbeats",
                              f"{root}/checkpoints/raw", settings, live),
        "windows": start_windows(open_source(), f"{root}/heartbeat_aggregates",
                                 f"{root}/checkpoints/windows", settings, live),
    }


def drain(spark, open_source, root, settings=StreamSettings()):
    """Run both queries over what the source holds now, then stop."""
    queries = start_pipeline(spark, open_source, root, settings, live=False)
    for query in queries.values():
        query.awaitTermination()
    return queries


def ingest_stream(requests, now_ms, **limits):
    """Accepted events of a request stream, the counters observed per micro-batch."""
    return accepted_events(observe_counters(classify_requests(requests, now_ms, **limits)))
