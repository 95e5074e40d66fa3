"""Quality classifier: a factorisation machine over words, structure and length.

A document's inputs are its hashed lower-case words (counts scaled to length one), shares
of character kinds, of repeated words and lines, and its length. All pairs of inputs
interact through low-rank factors; by the sum-of-squares identity a score takes one
pass over the document's own inputs. Label, lang, source and doc_id are never inputs.

The model is trained on the driver from at most ``TRAIN_ROWS`` labelled documents, those with
the smallest hash of their doc_id, so that its size has a bound, in an order that does not depend on
the files; every document is scored in full. Without any usable label nothing is known against a document, and all
score 1.

Null text is scored as empty text. Labels other than 0 and 1 are ignored; several labels
of a doc_id are all used. A null doc_id is never held out. An empty table gives an
empty result. Columns other than doc_id and text are carried along by the filter.
"""

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import text_or_empty

BUCKETS = 1 << 14
FACTORS = 8
TRAIN_ROWS = 6000
EPOCHS = 12
THRESHOLD = 0.7
STATS = 18
SEED = 7


def byte_kinds():
    """256 x 8 table: share of letters, capitals, digits, marks of four sorts, other bytes."""
    kinds = np.zeros((256, 8))
    for b in range(256):
        c = chr(b)
        kinds[b] = [c.isascii() and c.isalpha(), c.isascii() and c.isupper(), c.isascii() and c.isdigit(),
                    c in ".,;:'\"", c in "!?", c in "#$%&*@^~+=", c in "|<>{}[]()/\\_", b >= 128]
    return kinds


KINDS = byte_kinds()


def structure(raw, words, counts):
    """Shares and logarithms that describe a text's form."""
    size, n = max(len(raw), 1), max(len(words), 1)
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ KINDS / size
    lines = raw.split(b"\n")
    kinds = Counter(lines)
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    ended = sum(line.rstrip().endswith((b".", b"!", b"?", b'"')) for line in lines) / len(lines)
    return np.concatenate([shares, [
        np.log1p(size) / 10, np.log1p(n) / 10, size / n / 20, len(counts) / n,
        max(counts.values(), default=0) / n, again, 1 - len(kinds) / len(lines),
        max(kinds.values()) / len(lines), ended, np.log1p(len(lines)) / 10]])


def inputs(text):
    """Indices and values of a document's inputs; the structural ones come first."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.lower().split()
    counts = Counter(words)
    where = np.fromiter((crc32(w) % BUCKETS for w in counts), np.int64, len(counts))
    hashed = np.bincount(where, weights=np.fromiter(counts.values(), np.float64, len(counts)),
                         minlength=0) if len(counts) else np.empty(0)
    used = np.flatnonzero(hashed)
    values = hashed[used]
    values = values / (np.sqrt(values @ values) or 1.0)
    return (np.concatenate([np.arange(STATS), used + STATS]),
            np.concatenate([structure(raw, words, counts), values]))


def score_logit(model, index, value):
    """b + w x + (|V x|^2 - |V|^2 x^2) / 2 of one document."""
    value = value.copy()
    value[:STATS] = (value[:STATS] - model["mean"]) / model["scale"]
    v = model["factors"][index]
    crossed = value @ v
    return (model["bias"] + value @ model["weights"][index]
            + 0.5 * (crossed @ crossed - (value * value) @ (v * v).sum(1)))


def fit(rows):
    """Adam on logistic loss over ``rows`` of (indices, values, label)."""
    rng = np.random.default_rng(SEED)
    stats = np.array([v[:STATS] for _, v, _ in rows])
    size = STATS + BUCKETS
    model = {"bias": 0.0, "mean": stats.mean(0), "scale": stats.std(0) + 1e-3,
             "weights": np.zeros(size), "factors": rng.normal(0, 0.01, (size, FACTORS))}
    first = {k: np.zeros_like(model[k]) for k in ("weights", "factors")}
    second = {k: np.zeros_like(model[k]) for k in ("weights", "factors")}
    bias = [0.0, 0.0]
    step, size_of_batch = 0, 64
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(rows)), -(-len(rows) // size_of_batch)):
            step += 1
            slope = {k: {} for k in ("weights", "factors")}
            error_sum, touched, w_parts, v_parts = 0.0, [], [], []
            for r in batch:
                index, value, label = rows[r]
                value = value.copy()
                value[:STATS] = (value[:STATS] - model["mean"]) / model["scale"]
                v = model["factors"][index]
                crossed = value @ v
                logit = model["bias"] + value @ model["weights"][index] + 0.5 * (
                    crossed @ crossed - (value * value) @ (v * v).sum(1))
                error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) / len(batch)
                error_sum += error
                touched.append(index)
                w_parts.append(error * value)
                v_parts.append(error * (value[:, None] * crossed - v * (value * value)[:, None]))
            used, back = np.unique(np.concatenate(touched), return_inverse=True)
            slope = {"weights": np.bincount(back, np.concatenate(w_parts)) + 1e-5 * model["weights"][used],
                     "factors": np.stack([np.bincount(back, column) for column in np.concatenate(v_parts).T], 1)
                     + 1e-4 * model["factors"][used]}
            rate = 0.02 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, g in slope.items():
                first[k][used] = 0.9 * first[k][used] + 0.1 * g
                second[k][used] = 0.999 * second[k][used] + 0.001 * g * g
                model[k][used] -= rate * first[k][used] / (np.sqrt(second[k][used]) + 1e-8)
            bias = [0.9 * bias[0] + 0.1 * error_sum, 0.999 * bias[1] + 0.001 * error_sum ** 2]
            model["bias"] -= rate * bias[0] / (np.sqrt(bias[1]) + 1e-8)
    return {k: v if np.isscalar(v) else v.astype(np.float32) for k, v in model.items()}


def input_rows(batches):
    for batch in batches:
        found = [inputs(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("quality"),
             pa.array([i for i, _ in found], pa.list_(pa.int32())),
             pa.array([v for _, v in found], pa.list_(pa.float32()))], ["place", "quality", "index", "value"])


def held_out():
    """Whether crc32(doc_id as text) leaves remainder 2 by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs, labels, train_rows=TRAIN_ROWS):
    """The model, or None without labels.

    Training rows are chosen by keys alone and put in one order, so that the model is a function of the
    tables and not of their files; equal rows train once.
    """
    labelled = labels.filter("quality in (0, 1) AND doc_id IS NOT NULL").filter(~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    order = [F.xxhash64("doc_id"), "doc_id", "quality"]
    first = labelled.orderBy(*order).limit(train_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn(
        "text_key", F.xxhash64("text"))
    found = texts.select("doc_id", "text_key").join(F.broadcast(first), "doc_id").distinct().orderBy(
        *order, "text_key").limit(train_rows).collect()
    if not found:
        return None
    places = docs.sparkSession.createDataFrame(
        [(n, *row) for n, row in enumerate(found)], "place int, doc_id long, text_key long, quality int")
    rows = texts.join(F.broadcast(places), ["doc_id", "text_key"]).mapInArrow(
        input_rows, "place int, quality int, index array<int>, value array<float>")
    held = rows.dropDuplicates(["place"]).toArrow().sort_by("place")
    return fit([(np.array(i), np.array(v, np.float64), q) for i, v, q in zip(
        *(held.column(c).to_pylist() for c in ("index", "value", "quality")))])


def scorer(model):
    def score(batches):
        for batch in batches:
            if model is None:
                scores = np.ones(batch.num_rows)
            else:
                logits = np.array([score_logit(model, *inputs(t)) for t in batch.column("text").to_pylist()])
                scores = 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))
            kept = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())],
                                             [*batch.schema.names, "__score"])
    return score


def scored(docs, labels):
    """``docs`` with their score in the column ``__score``."""
    model = train(docs, labels)
    schema = T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())])
    return docs.mapInArrow(scorer(model), schema)


def quality_scores(docs, labels):
    """doc_id, held_out, score, predicted of each document."""
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    return rows.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
                       (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs, labels):
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    return scored(docs, labels).filter(F.col("__score") >= THRESHOLD).drop("__score")
