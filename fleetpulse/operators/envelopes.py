"""Request envelopes: one body holds one heartbeat, or a list accepted as a whole or not at all."""

from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.operators import strict
from fleetpulse.operators.validate import reject_reason

# Outcome, answer code, and whether the events of it are counted.
OUTCOME_CODES = {
    "too_large": 413,
    "unknown_kind": 404,
    "bad_json": 400,
    "empty": 400,
    "batch_too_large": 413,
    "invalid": 422,
    "accepted": 202,
}


def classify_requests(requests, now_ms, skew_ms=schema.CLOCK_SKEW_MS,
                      max_body_bytes=schema.MAX_BODY_BYTES, max_batch=schema.MAX_BATCH_EVENTS):
    """One row per request with ``outcome``, ``code``, ``reason``, ``n_events`` and ``events``.

    Everything is decided inside the row: no shuffle, no state. A body over the
    size cap is never parsed, any other one once. A body holds one document and no more, typed
    as ``operators.strict`` says; ``null`` is one with nothing in it, also as a list element.
    """
    body = F.col("body")
    fits = F.octet_length(body) <= max_body_bytes
    known = F.col("kind").isin("single", "batch")
    # one-element explodes hold the parse and the events, so that nothing below is evaluated again
    parsed = requests.withColumn("parsed", F.explode(F.array(strict.enclosed(F.when(known & fits, body)))))
    doc = F.try_variant_get("parsed", "$.doc", "variant")
    given = F.when(F.col("kind") == "single", F.array(doc)).otherwise(strict.listed(doc))
    given = F.when(strict.holds(F.col("parsed"), body), given)
    typed = strict.bound(F.transform(given, lambda value: strict.typed(value)), lambda all_of: F.when(
        ~F.exists(all_of, lambda event: event.isNull()), all_of))
    filled = parsed.withColumn("events", F.explode(F.array(typed))).drop("parsed")

    reasons = F.transform("events", lambda event, at: F.struct(
        at.alias("at"), reject_reason(now_ms, skew_ms, event.__getitem__).alias("reason")))
    first_bad = F.get(F.filter(reasons, lambda found: found["reason"].isNotNull()), 0)
    n_events = F.when(F.col("events").isNull(), 0).otherwise(F.size("events"))
    checked = (filled.withColumn("n_events", n_events)
               .withColumn("first_bad", F.when(n_events <= max_batch, first_bad)))
    outcome = (
        F.when(F.octet_length(body) > max_body_bytes, "too_large")
        .when(~F.coalesce(F.col("kind").isin("single", "batch"), F.lit(False)), "unknown_kind")
        .when(F.col("events").isNull(), "bad_json")
        .when(F.col("n_events") == 0, "empty")
        .when(F.col("n_events") > max_batch, "batch_too_large")
        .when(F.col("first_bad").isNotNull(), "invalid")
        .otherwise("accepted")
    )
    codes = F.create_map(*[F.lit(x) for pair in OUTCOME_CODES.items() for x in pair])
    return checked.select(
        "request_id", "kind", "n_events", "events",
        outcome.alias("outcome"),
        F.col("first_bad.at").alias("first_bad_index"),
        F.col("first_bad.reason").alias("reason"),
    ).withColumn("code", codes[F.col("outcome")])


def accepted_events(classified):
    """The events of accepted requests, one per row, with their place in the request."""
    rows = classified.where(F.col("outcome") == "accepted")
    return (rows.select("request_id", F.posexplode("events").alias("position", "event"))
            .select("request_id", "position", "event.*"))


def _counted():
    n = F.col("n_events").cast("long")
    outcome = F.col("outcome")
    accepted = F.sum(F.when(outcome == "accepted", n).otherwise(0))
    rejected = F.sum(F.when(outcome == "bad_json", 1).when(outcome == "invalid", n).otherwise(0))
    return (F.count("*").alias("requests_total"),
            F.coalesce(accepted, F.lit(0)).alias("accepted_total"),
            F.coalesce(rejected, F.lit(0)).alias("rejected_total"))


def outcome_counters(classified):
    """Running totals: bad JSON counts one, an invalid request all its events, size failures none."""
    return classified.agg(*_counted())


def observe_counters(classified, name="ingest_counters"):
    """The same totals reported once per micro-batch or action, without a second pass."""
    return classified.observe(name, *_counted())
