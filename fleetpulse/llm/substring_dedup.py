"""Removing repeated 100-byte strings by externally sorted, induced suffixes.

A full suffix array of a table is many times its size. Here only sampled suffixes
are sorted: those at anchors (see ``anchors``), which equal windows share. Sorting is Spark's own
external sort of tuples by (gram, context, document, position), so a shard may be far larger
than memory; the order of all other suffixes is induced from the anchor they reach:

1. Anchor tuples are sorted. Tuples with the same context have their whole common prefix in the
   sort key: of them, all but the first are repeats, with all windows they stand for. A
   tuple whose gram occurs with another context too is undecided.
2. Only for undecided anchors, the suffixes between them and their neighbours are sorted
   in turn, by the hash of their 100 bytes; all but the first of equals are repeats.
3. The windows found are gathered by document, and their bytes are taken out.

Repeats within one block of documents are folded before the sort, so a string that a third
of all documents hold is sent once per block. Tuples carry 64-bit hashes.

Order is by doc_id, then start; the same place of rows that repeat a doc_id is no earlier
one. Rows that repeat a doc_id are told apart by 32 bits of their texts. A row without doc_id
counts as a document of its own behind all ids below 2^62, in the order of a 62-bit hash of its text. Null
text counts as empty; texts under 100 bytes lose nothing. An empty table gives an empty
result. Columns other than doc_id and text are ignored.
"""

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetpulse.llm.anchors import WINDOW, anchors, window_hashes
from fleetpulse.llm.common import in_blocks, mixed, release_shuffles, text_or_empty, written

BLOCK_DOCS = 2000
TAG_BITS = 32
LAST_ID = (1 << 63) - 1
HASHED_IDS = 1 << 62

#: route: sort key; at: start * 2^32 + tag of the text; span: windows after the first; kind: see below
TUPLE = "route bigint, context bigint, id bigint, at bigint, span int, kind int"
FOUND = "id bigint, at bigint, span int, kind int"
OPEN, REPEAT, UNDECIDED = 0, 1, 2


def folded(route, context, ids, at, span):
    """Tuples of a block; those that repeat an earlier one of it are marked and dealt out evenly."""
    order = np.lexsort((at, ids, context, route))
    route, context, ids, at, span = (c[order] for c in (route, context, ids, at, span))
    repeat = later_equals(route, context, ids, at)[0]
    route = np.where(repeat, mixed(ids.view(np.uint64) * np.uint64(31) + at.view(np.uint64)).view(np.int64), route)
    return pa.RecordBatch.from_arrays(
        [pa.array(route), pa.array(context), pa.array(ids), pa.array(at), pa.array(span.astype(np.int32)),
         pa.array(np.where(repeat, REPEAT, OPEN).astype(np.int32))],
        ["route", "context", "id", "at", "span", "kind"])


def later_equals(route, context, ids, at):
    """Of sorted tuples: (repeats an earlier place, starts a run of equals, starts a new route)."""
    new_route = np.ones(len(route), bool)
    new_route[1:] = route[1:] != route[:-1]
    new_run = new_route.copy()
    new_run[1:] |= context[1:] != context[:-1]
    first = np.flatnonzero(new_run)[np.cumsum(new_run) - 1] if len(route) else np.empty(0, np.int64)
    same_place = (ids == ids[first]) & (at >> TAG_BITS == at[first] >> TAG_BITS)
    return ~new_run & ~same_place, new_run, new_route


def documents_of(rows):
    """(id, tag, bytes of the text) of a table's rows."""
    for doc, tag, text in zip(*(rows.column(c).to_pylist() for c in ("id", "tag", "text"))):
        yield doc, tag, np.frombuffer(text.encode("utf-8", "replace"), np.uint8)


def joined(parts):
    columns = list(zip(*parts)) or [[np.empty(0, np.int64)]] * 5
    return [np.concatenate(c) for c in columns]


def anchor_tuples(batches):
    for rows in in_blocks(batches, BLOCK_DOCS):
        parts = []
        for doc, tag, data in documents_of(rows):
            _, low, high, grams, contexts = anchors(data)
            parts.append((grams.view(np.int64), contexts.view(np.int64), np.full(len(low), doc, np.int64),
                          low << TAG_BITS | tag, high - low))
        yield folded(*joined(parts))


def window_tuples(batches):
    """Windows of the undecided anchors of each document (columns at, span as lists)."""
    for rows in in_blocks(batches, BLOCK_DOCS):
        parts = []
        for (doc, tag, data), spans in zip(documents_of(rows), rows.column("spans").to_pylist()):
            for s in spans:
                low = s["at"] >> TAG_BITS
                if low + s["span"] + WINDOW <= len(data):
                    hashes = window_hashes(data, low, low + s["span"]).view(np.int64)
                    parts.append((hashes, hashes, np.full(len(hashes), doc, np.int64),
                                  np.arange(low, low + len(hashes)) << TAG_BITS | tag, np.zeros(len(hashes), np.int64)))
        yield folded(*joined(parts))


def sorted_repeats(batches):
    """Repeats and undecided tuples of a sorted partition, batch by batch.

    Between batches only the first tuple of the run in progress is held, and whether its
    route has been told to be undecided.
    """
    held, told = [np.empty(0, np.int64)] * 5, False
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        columns = [batch.column(c).to_numpy().astype(np.int64) for c in ("route", "context", "id", "at", "span")]
        yield found_rows(*(c[kind == REPEAT] for c in columns[2:]), REPEAT)
        columns = [np.concatenate([h, c[kind == OPEN]]) for h, c in zip(held, columns)]
        route, context, ids, at, span = columns
        if not len(route):
            continue
        repeat, new_run, new_route = later_equals(route, context, ids, at)
        undecided = ~new_run & ~repeat
        firsts = np.flatnonzero(new_run)
        shared = ~new_route[firsts[1:]]
        undecided[firsts[1:][shared]] = True
        undecided[firsts[:-1][shared]] = True
        last = firsts[-1]
        told_last = bool(undecided[last]) or (told and last == 0)
        if told:
            undecided[0] = False
        yield found_rows(ids[repeat], at[repeat], span[repeat], REPEAT)
        yield found_rows(ids[undecided], at[undecided], span[undecided], UNDECIDED)
        held, told = [c[last:last + 1] for c in columns], told_last


def found_rows(ids, at, span, kind):
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(at), pa.array(span.astype(np.int32)), pa.array(np.full(len(ids), kind, np.int32))],
        ["id", "at", "span", "kind"])


def found(tuples, label):
    in_order = tuples.repartition("route").sortWithinPartitions("route", "context", "id", "at")
    return written(in_order.mapInArrow(sorted_repeats, FOUND), label)


def by_document(rows):
    """id, tag, spans: what was found, gathered by document."""
    return rows.groupBy("id", F.col("at").bitwiseAND((1 << TAG_BITS) - 1).alias("tag")).agg(
        F.collect_list(F.struct("at", "span")).alias("spans"))


def with_spans(texts, rows, how):
    spans = by_document(rows).withColumnsRenamed({"id": "__id", "tag": "__tag"})
    return texts.join(spans, (F.col("id") == F.col("__id")) & (F.col("tag") == F.col("__tag")), how)


def removed_rows(batches):
    for batch in batches:
        out = []
        for (doc, _, data), own, spans in zip(documents_of(batch), batch.column("doc_id").to_pylist(),
                                              batch.column("spans").to_pylist()):
            change = np.zeros(len(data) + 1, np.int64)
            for s in spans or ():
                low = s["at"] >> TAG_BITS
                change[min(low, len(data))] += 1
                change[min(low + s["span"] + WINDOW, len(data))] -= 1
            gone = np.cumsum(change[:-1]) > 0
            runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            out.append((own, len(data), int(gone.sum()), runs, sha256(data[~gone].tobytes()).hexdigest()))
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def ids_repeat(docs):
    """Whether any doc_id stands on several rows."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).filter("id is not null")
    return not ids.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def keyed(docs):
    """doc_id, id, tag, text; the tag is 0 where the id alone tells a row apart, as tuples are smaller then."""
    doc_id, text = F.col("doc_id").cast("long"), text_or_empty()
    hashed = F.lit(LAST_ID) - F.xxhash64(text).bitwiseAND(HASHED_IDS - 1)
    tag = F.crc32(F.encode(text, "utf-8"))
    if not ids_repeat(docs):
        tag = F.when(doc_id.isNull(), tag).otherwise(0)
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, hashed).alias("id"),
                       tag.cast("long").alias("tag"), text.alias("text"))


def without_repeats(docs):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    texts = keyed(docs)
    key = texts.select("id", "tag", "text")
    by_anchor = found(key.mapInArrow(anchor_tuples, TUPLE), "anchor-repeats")
    release_shuffles(docs.sparkSession)
    undecided = with_spans(key, by_anchor.filter(F.col("kind") == UNDECIDED), "inner").select(
        "id", "tag", "text", "spans")
    by_window = found(undecided.mapInArrow(window_tuples, TUPLE), "window-repeats")
    del undecided
    release_shuffles(docs.sparkSession)
    repeats = by_anchor.unionByName(by_window).filter(F.col("kind") == REPEAT)
    spans = written(by_document(repeats), "repeats")
    release_shuffles(docs.sparkSession)
    held = spans.withColumnsRenamed({"id": "__id", "tag": "__tag"})
    all_texts = texts.join(held, (F.col("id") == F.col("__id")) & (F.col("tag") == F.col("__tag")), "left")
    return all_texts.select("doc_id", "id", "tag", "text", "spans").mapInArrow(
        removed_rows, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
