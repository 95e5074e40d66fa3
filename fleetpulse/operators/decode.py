"""JSON messages to typed heartbeats, with the undecodable ones kept apart."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse import schema
from fleetpulse.functions import number_or_zero, text_or_empty

BROKEN = "_broken"
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}


def typed_json(text, shape):
    """Parse text as ``shape``; a value of the wrong type fills ``_broken``."""
    with_broken = T.StructType(shape.fields + [T.StructField(BROKEN, T.StringType())])
    return F.from_json(text, with_broken, JSON_OPTIONS)


def parsed_ok(doc):
    return doc.isNotNull() & doc[BROKEN].isNull()


def decodable(doc):
    """Parsed, with a time that a timestamp can hold: another would stop every later step."""
    return parsed_ok(doc) & number_or_zero(doc["timestamp_ms"]).between(*schema.TIMESTAMP_MS)


def parse_messages(messages, value="value", tags=()):
    """Add ``doc`` next to the message columns.

    The one-element explode keeps later filters above the parse, so that each
    body is parsed once and not again inside a pushed-down predicate.
    """
    text = F.col(value).cast("string")
    return messages.withColumn("doc", F.explode(F.array(
        typed_json(text, schema.with_tags(schema.HEARTBEAT, tags)))))


def decode_heartbeats(messages, value="value", keep=(), tags=()):
    """Decodable messages as typed rows; absent numbers become 0, absent text stays null.

    ``keep`` names message columns to carry along, ``tags`` further text fields to read.
    """
    good = parse_messages(messages, value, tags).where(decodable(F.col("doc")))
    return good.select(
        *keep,
        *[F.col(f"doc.{name}").alias(name) for name in (*schema.TEXT_FIELDS, *tags)],
        *[number_or_zero(F.col(f"doc.{name}")).cast(schema.HEARTBEAT[name].dataType).alias(name)
          for name in schema.NUMBER_FIELDS],
    )


def dead_letters(messages, value="value", tags=()):
    """The messages that ``decode_heartbeats`` leaves out, with all their columns."""
    return parse_messages(messages, value, tags).where(~decodable(F.col("doc"))).drop("doc")


def encode_heartbeats(tags=()):
    """Key and value columns of JSON messages; a zero cpu or mem reading is left out of the document."""
    reading = {name: F.nullif(number_or_zero(F.col(name)), F.lit(0.0)).alias(name)
               for name in ("cpu_usage", "mem_usage")}
    fields = [text_or_empty(F.col(name)).alias(name) for name in (*schema.TEXT_FIELDS, *tags)]
    fields += [number_or_zero(F.col(name)).alias(name) for name in ("timestamp_ms", "latency_ms")]
    fields += list(reading.values())
    return (text_or_empty(F.col("device_id")).alias("key"),
            F.to_json(F.struct(*fields)).alias("value"))
