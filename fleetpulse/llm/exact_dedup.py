"""Exact dedup by exchanging Golomb-coded fingerprints.

1. Each sender, a block of rows of one input task, sorts the fingerprints of its
   normalised texts and codes them, one message per owner of a fingerprint range.
2. An owner decodes its messages and answers each with a bitmap of the
   fingerprints that another sender has too.
3. Rows marked so, or repeated within their own sender, are suspects. Only their
   texts are grouped, byte by byte, folded before the shuffle.

A fingerprint that meets by chance only makes a suspect. A group of copies of any
size sends one fingerprint per sender and is folded by the grouping.

Null text counts as empty, and empty texts are equal. Rows that repeat a doc_id are
rows of their own; all rows with a group's smallest doc_id stay. Null doc_ids come
after all others; a group of only such rows keeps them all. An empty table gives an
empty result. Columns other than doc_id and text are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from fleetpulse.llm.common import binaries, in_blocks, shuffle_width, text_or_empty, written
from fleetpulse.llm.golomb import decode, encode

WHITE_SPACE = r"[\x20\x09-\x0D]+"
FINGERPRINT_BITS = 48
SENDER_ROWS = 1 << 16
OWNER_ROWS = 1 << 20

MESSAGE = ("block string, owner int, code binary, repeats array<int>, "
           "ids array<bigint>, digests array<binary>")
ANSWER = "block string, owner int, bitmap binary"


def normalised(column):
    return F.regexp_replace(column, WHITE_SPACE, " ")


def owner_start(owner, owners):
    """The smallest fingerprint of an owner's range."""
    return -(-(owner << FINGERPRINT_BITS) // owners)


def fingerprints_of(digests):
    """The leading bits of 32-byte digests, as uint64."""
    lead = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)
    return lead >> np.uint64(64 - FINGERPRINT_BITS)


def sender(owners, sender_rows):
    bounds = np.array([owner_start(o, owners) for o in range(owners + 1)], np.uint64)

    def send(batches):
        part = TaskContext.get().partitionId()
        for number, rows in enumerate(in_blocks(batches, sender_rows)):
            digests = rows.column("digest").to_pylist()
            prints = fingerprints_of(digests)
            order = np.argsort(prints, kind="stable")
            values, first, repeats = np.unique(prints[order], return_index=True, return_counts=True)
            ids = rows.column("doc_id").combine_chunks().take(pa.array(order)).to_pylist()
            cuts = np.searchsorted(values, bounds)
            row_cuts = np.append(first, len(order))[cuts]
            out = {name: [] for name in ("owner", "code", "repeats", "ids", "digests")}
            for owner in np.flatnonzero(np.diff(cuts)):
                a, b, ra, rb = cuts[owner], cuts[owner + 1], row_cuts[owner], row_cuts[owner + 1]
                start, end = int(bounds[owner]), int(bounds[owner + 1])
                out["owner"].append(int(owner))
                out["code"].append(encode(values[a:b], start, end - start))
                out["repeats"].append(repeats[a:b].tolist())
                out["ids"].append(ids[ra:rb])
                out["digests"].append([digests[i] for i in order[ra:rb]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{part}-{number}"] * len(out["owner"])), pa.array(out["owner"], pa.int32()),
                 binaries(out["code"]), pa.array(out["repeats"], pa.list_(pa.int32())),
                 pa.array(out["ids"], pa.list_(pa.int64())),
                 pa.array(out["digests"], pa.list_(pa.binary()))],
                ["block", "owner", "code", "repeats", "ids", "digests"])
    return send


def owner_answers(owners):
    def answer(messages):
        owner = messages.column("owner")[0].as_py()
        start = owner_start(owner, owners)
        parts = [decode(code, start) for code in messages.column("code").to_pylist()]
        _, where, senders = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = np.split(senders[where] > 1, np.cumsum([len(p) for p in parts])[:-1])
        return pa.Table.from_arrays(
            [messages.column("block"), messages.column("owner"),
             binaries([np.packbits(s).tobytes() for s in shared])], ["block", "owner", "bitmap"])
    return answer


def marked_ids(batches):
    """Of messages joined with their bitmaps: the doc_ids of the marked rows."""
    for batch in batches:
        found = []
        for repeats, ids, bitmap in zip(*(batch.column(c).to_pylist() for c in ("repeats", "ids", "bitmap"))):
            repeats = np.array(repeats)
            marked = (np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(repeats)) > 0) | (repeats > 1)
            found += [ids[i] for i in np.flatnonzero(np.repeat(marked, repeats))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["suspect"])


def exact_groups(docs, *, sender_rows=SENDER_ROWS, owner_rows=OWNER_ROWS):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        normalised(text_or_empty()).alias("plain"))
    owners = max(shuffle_width(spark), math.ceil(docs.count() / owner_rows))
    digests = texts.select("doc_id", F.unhex(F.sha2("plain", 256)).alias("digest"))
    messages = written(digests.mapInArrow(sender(owners, sender_rows), MESSAGE), "fingerprints")

    answers = messages.select("block", "owner", "code").groupBy("owner").applyInArrow(
        owner_answers(owners), ANSWER)
    suspects = messages.select("block", "owner", "repeats", "ids").join(
        answers, ["block", "owner"]).select("repeats", "ids", "bitmap").mapInArrow(
        marked_ids, "suspect bigint")

    checked = texts.join(suspects, F.col("doc_id").eqNullSafe(F.col("suspect")), "left_semi")
    groups = checked.groupBy("plain").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter(
        "group_size > 1").select(F.unhex(F.sha2("plain", 256)).alias("digest"), "keep_id", "group_size")

    rows = messages.select(F.explode(F.arrays_zip("ids", "digests")).alias("r")).select(
        F.col("r.ids").alias("doc_id"), F.col("r.digests").alias("digest"))
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.join(groups, "digest", "left").select(
        "doc_id", keep.alias("keep_id"), size.alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs):
    """The rows of ``docs`` that stay, one for each group of equal texts, with all their columns."""
    stay = exact_groups(docs).filter("kept").select(F.col("doc_id").alias("__stay"), F.unhex("text_sha256").alias("__text"))
    keyed = docs.withColumn("__digest", F.unhex(F.sha2(normalised(text_or_empty()), 256)))
    kept = keyed.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("__stay")) & (F.col("__digest") == F.col("__text")),
                      "left_semi")
    return kept.dropDuplicates(["doc_id", "__digest"]).drop("__digest")
