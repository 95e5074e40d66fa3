"""Importance resampling towards the texts of a target table.

1. An untrained pre-tokeniser splits each text, lower-cased in ASCII, and gives every word with its
   offsets. A feature is a window of one word, or of two consecutive ones joined by a space; the bytes
   between the offsets of a window are hashed by CRC-32 into a bucket. Texts are read once: buckets
   are written, two bytes for each feature.
2. Buckets of all documents and of all target texts are counted. The gain of a bucket compares both
   shares in thousandths of a nat; a document's weight is the floored mean of its features' gains.
3. A Gumbel number hashed from seed and doc_id makes the highest scores a draw without replacement in
   proportion to the weights. Rows are ranked by one range shuffle, each row's place in its task and the
   counts of the tasks before it.

Null text counts as empty, which has no words, weight 0 and no rank. Rows that repeat a doc_id get the
same noise and ranks of their own, as do ties; null ids share one noise and come after others in a tie. An
empty target gives gains by the documents' counts alone; an empty table gives an empty result. Very
long texts are split piece by piece. Other columns are carried along where asked for.
"""

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import binaries, text_or_empty, written

#: The characters of a word after lower-casing: digits, a to z and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 7
SHARE_PERCENT = 25
MIN_WORDS = 20
MAX_RUN = 2
#: Characters split, and bytes of texts hashed, at a time.
PIECE_CHARS = 1 << 20
BLOCK_BYTES = 1 << 22
#: Longer words are hashed one by one.
COLUMN_BYTES = 48


def crc_table():
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = (values >> np.uint32(1)) ^ np.where(values & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return values


def word_offsets(splitter, text):
    """Start and end offsets of all words, in characters, as a flat array."""
    found, start = [], 0
    while start < len(text):
        size = PIECE_CHARS
        while True:
            piece = text[start:start + size]
            spans = [span for _, span in splitter.pre_tokenize_str(piece)]
            # a word at the end of a piece may go on: the next piece starts with it
            cut = spans and spans[-1][1] == len(piece) and start + size < len(text)
            if not cut or spans[-1][0] > 0:
                break
            size *= 2
        ends = spans.pop()[0] if cut else len(piece)
        found.append(np.fromiter(itertools.chain.from_iterable(spans), np.int64, 2 * len(spans)) + start)
        start += ends
    return np.concatenate(found) if found else np.empty(0, np.int64)


def byte_offsets(raw, offsets):
    """Character offsets as offsets into the UTF-8 bytes."""
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return offsets if len(starts) == len(raw) else np.append(starts, len(raw))[offsets]


def crc_of_words(table, data, starts, ends, state):
    """CRC states after the bytes of each word, given the states before; all words by columns of bytes."""
    state, length = state.copy(), ends - starts
    order = np.argsort(-length, kind="stable")
    longer = len(order)
    short = order[np.searchsorted(-length[order], -COLUMN_BYTES):]
    counts = np.bincount(np.minimum(length[short], COLUMN_BYTES), minlength=COLUMN_BYTES + 1)[::-1].cumsum()[::-1]
    for column in range(min(COLUMN_BYTES, int(length[short].max(initial=0)))):
        longer = short[:counts[column + 1]]
        byte = data[starts[longer] + column]
        state[longer] = table[(state[longer] ^ byte) & np.uint32(255)] ^ (state[longer] >> np.uint32(8))
    for i in order[:len(order) - len(short)]:
        word = data[starts[i]:ends[i]].tobytes()
        state[i] = zlib.crc32(word, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def window_buckets(table, data, starts, ends, follows, buckets):
    """Buckets of the one-word windows and of the two-word windows that end at each word.

    ``follows`` tells whether a word is preceded by another of its text.
    """
    fresh = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    single = crc_of_words(table, data, starts, ends, fresh)
    second = np.flatnonzero(follows)
    before = single[second - 1]
    spaced = table[(before ^ np.uint32(0x20)) & np.uint32(255)] ^ (before >> np.uint32(8))
    double = crc_of_words(table, data, starts[second], ends[second], spaced)
    return ((~single) % np.uint32(buckets)).astype("<u2"), ((~double) % np.uint32(buckets)).astype("<u2")


def blocks_of_bytes(texts):
    """Ranges of rows with at most BLOCK_BYTES of text each, or one row."""
    start, held = 0, 0
    for row, text in enumerate(texts):
        if row > start and held + len(text) > BLOCK_BYTES:
            yield start, row
            start, held = row, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def featurise(buckets):
    """Adds __words and __buckets (little-endian 16-bit numbers) to batches that end with __text."""
    def add(batches):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        splitter, table = Split(Regex(WORD), behavior="removed", invert=True), crc_table()
        for batch in batches:
            column = batch.column("__text")
            counts, out = [], []
            raws = [s.as_py().encode().lower() for s in column]
            for first, past in blocks_of_bytes(raws):
                spans, base = [], 0
                for raw in raws[first:past]:
                    spans.append(byte_offsets(raw, word_offsets(splitter, raw.decode())) + base)
                    base += len(raw)
                words = np.array([len(s) // 2 for s in spans])
                flat, firsts = np.concatenate(spans), np.cumsum(words) - words
                follows = np.ones(len(flat) // 2, bool)
                follows[firsts[words > 0]] = False
                data = np.frombuffer(b"".join(raws[first:past]), np.uint8)
                single, double = window_buckets(table, data, flat[::2], flat[1::2], follows, buckets)
                second = firsts - np.cumsum(words > 0) + (words > 0)
                for n, a, b in zip(words.tolist(), firsts.tolist(), second.tolist()):
                    out.append(single[a:a + n].tobytes() + double[b:b + max(n - 1, 0)].tobytes())
                counts += words.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), binaries(out)],
                [*batch.schema.names[:-1], "__words", "__buckets"])
    return add


def featurised(docs, columns, buckets):
    rows = docs.select(*columns, text_or_empty().alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("__words", T.LongType()),
                           T.StructField("__buckets", T.BinaryType())])
    return rows.mapInArrow(featurise(buckets), schema)


def bucket_counts(features, buckets):
    """How often each bucket occurs: on the driver, as there are ``buckets`` numbers in all."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cell in batch.column("__buckets"):
                total += np.bincount(np.frombuffer(cell.as_buffer(), "<u2"), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    counted = features.select("__buckets").mapInArrow(count, "bucket long, n long")
    held = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        held[row.bucket] = row.n
    return held


def gains(source, target):
    """Thousandths of a nat by which each bucket is likelier in the target, smoothed by one, floored."""
    buckets, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(
        float(t + 1) * float(all_source + buckets) / (float(s + 1) * float(all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(gain):
    def add(batches):
        for batch in batches:
            features, weights = [], []
            for cell in batch.column("__buckets"):
                found = np.frombuffer(cell.as_buffer(), "<u2")
                features.append(len(found))
                weights.append(int(gain[found].sum()) // len(found) if len(found) else 0)
            kept = [name for name in batch.schema.names if name != "__buckets"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(features, pa.int64()), pa.array(weights, pa.int64())],
                [*kept, "__features", "__weight"])
    return add


def noise(seed):
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit("null"))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def ranked(rows, share_percent, min_words):
    """``rows`` with __rank: the place by falling score of the drawn ones, null for all others."""
    may = F.col("__words") >= min_words
    ordered = rows.repartitionByRange(F.desc(may), F.desc("__score"), F.col("__id").asc_nulls_last(), F.spark_partition_id())
    placed = written(ordered.sortWithinPartitions(
        F.desc(may), F.desc("__score"), F.col("__id").asc_nulls_last()).withColumn(
        "__place", F.monotonically_increasing_id()), "resampling-order")
    task = F.shiftright("__place", 33)
    # one row for each task of the shuffle
    sizes = sorted(tuple(r) for r in placed.groupBy(task.alias("task")).agg(
        F.count("*"), F.count_if(may)).collect())
    starts, eligible = {}, 0
    for number, _, n in sizes:
        starts[number] = eligible
        eligible += n
    drawn = share_percent * eligible // 100
    before = F.element_at(F.from_json(
        F.lit("{%s}" % ",".join(f'"{k}":{v}' for k, v in starts.items())), "map<string,long>"), task.cast("string"))
    rank = before + F.col("__place").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("__rank", F.when(may & (rank <= drawn), rank)).drop("__place")


def scored(docs, target, columns=(), *, share_percent=SHARE_PERCENT, min_words=MIN_WORDS, buckets=BUCKETS, seed=SEED):
    """``columns`` of each document with __id, __words, __features, __weight, __score and __rank."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are 16-bit numbers")
    features = written(featurised(docs, [F.col("doc_id").cast("long").alias("__id"), *columns], buckets), "resampling-features")
    aims = featurised(target, [], buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(aims, buckets))
    kept = [f for f in features.schema.fields if f.name != "__buckets"]
    schema = T.StructType([*kept, T.StructField("__features", T.LongType()), T.StructField("__weight", T.LongType())])
    weighed = features.mapInArrow(weigh(gain), schema)
    return ranked(weighed.withColumn("__score", F.col("__weight") + noise(seed)), share_percent, min_words)


def resampled(docs, target, **settings):
    """The drawn rows of ``docs`` with all their columns."""
    found = scored(docs, target, [F.struct("*").alias("__row")], **settings)
    return found.filter("__rank is not null").select("__row.*")


def resampling_ranks(docs, target, **settings):
    """doc_id, n_features, weight, score and rank (null where not drawn) of every document."""
    return scored(docs, target, **settings).select(
        F.col("__id").alias("doc_id"), F.col("__features").alias("n_features"), F.col("__weight").alias("weight"),
        F.col("__score").alias("score"), F.col("__rank").alias("rank"))
