"""Packing documents into training windows by lexical retrieval.

Documents become token ids by a public byte-level BPE vocabulary, with id 1 at the end. Full
windows of a long document are sequences of their own; what is left of each document is a
fragment. Related fragments of the whole table are brought together first: at most ``PIVOTS`` are
pivots, every fragment asks a BM25 index of the pivots for its best two, and the table is sorted
by these. Each task then packs a range of that order in shards of ``SHARD`` fragments: a shard has
a BM25 index, the oldest unused fragment is the seed of the next window, and its best unused
neighbours fill it, the last one cut where the window ends. What a shard leaves goes on to the
next one of the task; the last, short window of a task is split into lengths that are powers
of two, so nothing is padded.

A seed takes neighbours from its own shard only, so one that the order puts elsewhere is not
found; the README has the measured share. Within a shard the search is exact: a query is all
ids of its fragment. Inverse document frequencies and the mean length come from the whole table;
they are one number per id of the vocabulary, a bounded size.

Null text counts as empty and is the single id 1. Rows that repeat a doc_id are documents of
their own. An empty table gives an empty result. Columns other than doc_id and text are
ignored.
"""

import base64
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import functions as F

from fleetpulse.llm.common import in_blocks, text_or_empty, written

VOCABULARY = "byte_bpe_50k.tiktoken"
TEXT_END, END_MARK, END_MARK_ID = 1, "<|endoftext|>", 50256
WINDOW = 2048
SHARD = 2048
READ_ROWS = 512
PIVOTS, PIVOT_SHARE = 1024, 32  # at most so many, and one in so many fragments
DENSE = 16  # an id in more than one in so many fragments of an index has a row of weights there
K1, B = 1.2, 0.75
ASKED_AT_ONCE = 256
FIRST_NEIGHBOURS = 32

PARTS = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
         "sequence_id bigint, ids binary, terms array<int>, term_docs array<int>")
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
PLACED = "doc_id bigint, start bigint, doc_tokens bigint, ids binary, near int, second int, score float"
KIND = np.dtype("<u2")


def encoding(vocabulary):
    """The vocabulary's encoder; one per worker process, kept in the library's own registry."""
    known = tiktoken.registry.ENCODINGS
    if vocabulary not in known:
        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        known[vocabulary] = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN,
                                              mergeable_ranks=ranks, special_tokens={END_MARK: END_MARK_ID})
    return known[vocabulary]


def token_ids(encoder, text):
    return np.append(encoder.encode_to_numpy(text, allowed_special="all").astype(KIND), KIND.type(TEXT_END))


def distinct(ids):
    """The distinct ids in order; 16-bit numbers are sorted by radix."""
    ordered = np.sort(ids, kind="stable")
    first = np.empty(len(ordered), bool)
    first[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def checksum(ids):
    return crc32(ids.astype("<u4").tobytes())


def tokenizer(vocabulary):
    """Rows of full windows (with their sequence_id), of fragments (with ids), and of term counts."""
    def tokenize(batches):
        encoder, part = encoding(vocabulary), TaskContext.get().partitionId()
        docs_with = np.zeros(encoder.n_vocab, np.int64)
        number = 0
        for rows in in_blocks(batches, READ_ROWS):
            out = []
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                ids = token_ids(encoder, text)
                docs_with[distinct(ids)] += 1
                full = len(ids) // WINDOW * WINDOW
                for start in range(0, full, WINDOW):
                    out.append((doc_id, start, WINDOW, checksum(ids[start:start + WINDOW]), len(ids),
                                (part << 32) + number, None))
                    number += 1
                if full < len(ids):
                    out.append((doc_id, full, len(ids) - full, None, len(ids), None, ids[full:].tobytes()))
            yield part_rows(out)
        seen = np.flatnonzero(docs_with)
        yield part_rows([], seen, docs_with[seen])
    return tokenize


def part_rows(rows, terms=None, counts=None):
    columns = list(zip(*rows)) if rows else [[]] * 7
    if terms is not None:
        columns = [[None]] * 7
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id")
    own = None if terms is None else terms.tolist()
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in columns[:6]], pa.array(columns[6], pa.binary()),
         pa.array([own] * len(columns[0]), pa.list_(pa.int32())),
         pa.array([None if own is None else counts.tolist()] * len(columns[0]), pa.list_(pa.int32()))],
        [*names, "ids", "terms", "term_docs"])


class Fragment:
    """Unplaced ids of a document; placing some moves the start."""
    __slots__ = ("doc_id", "start", "tokens", "ids")

    def __init__(self, doc_id, start, tokens, ids):
        self.doc_id, self.start, self.tokens, self.ids = doc_id, start, tokens, ids


class Shard:
    """BM25 over the fragments of a shard."""

    def __init__(self, fragments, idf, mean=None):
        count, sizes = len(fragments), np.array([len(f.ids) for f in fragments])
        keys, counts = np.unique(np.concatenate([f.ids for f in fragments]).astype(np.int64) * count
                                 + np.repeat(np.arange(count), sizes), return_counts=True)
        term, owner = keys // count, keys % count
        norm = K1 * (1 - B + B * sizes / (mean or sizes.mean()))
        weight = (idf[term] * counts * (K1 + 1) / (counts + norm[owner])).astype(np.float32)
        self.start = np.searchsorted(term, np.arange(len(idf) + 1))
        self.owner, self.weight, self.fragments = owner, weight, fragments
        held = np.diff(self.start)
        common = np.flatnonzero(held > count / DENSE)
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), count), np.float32)
        where = self.row[term] >= 0
        self.rows[self.row[term[where]], owner[where]] = weight[where]
        self.queries = [distinct(f.ids) for f in fragments]
        self.unused = np.ones(count, bool)

    def scores(self, terms):
        """Of all fragments, for a query of distinct ids."""
        row = self.row[terms]
        rare = terms[row < 0]
        starts = self.start[rare]
        sizes = self.start[rare + 1] - starts
        at = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        found = np.bincount(self.owner[at], self.weight[at], len(self.unused))
        return found + self.rows[row[row >= 0]].sum(0)

    def scores_of(self, queries):
        """A row of scores over all fragments for each query: the common ids by one product of matrices."""
        sizes = np.array([len(q) for q in queries])
        terms, asker = np.concatenate(queries).astype(np.int64), np.repeat(np.arange(len(queries)), sizes)
        row = self.row[terms]
        asked = np.zeros((len(queries), len(self.rows)), np.float32)
        asked[asker[row >= 0], row[row >= 0]] = 1
        rare, by = terms[row < 0], asker[row < 0]
        starts = self.start[rare]
        held = self.start[rare + 1] - starts
        at = np.arange(held.sum()) + np.repeat(starts - np.cumsum(held) + held, held)
        count = len(self.unused)
        found = np.bincount(self.owner[at] + np.repeat(by * count, held), self.weight[at], count * len(queries))
        return found.reshape(len(queries), count) + asked @ self.rows

    def neighbours(self, seed):
        """Numbers of the unused fragments that share an id with ``seed``, best first."""
        scores = self.scores(self.queries[seed].astype(np.int64))
        scores[~self.unused] = 0
        # most windows are full after a few neighbours: the best come first, the others only when asked for
        least = np.partition(scores, -FIRST_NEIGHBOURS)[-FIRST_NEIGHBOURS] if len(scores) > FIRST_NEIGHBOURS else -1.0
        for found in (np.flatnonzero((scores > 0) & (scores >= least)), np.flatnonzero((scores > 0) & (scores < least))):
            yield from found[np.argsort(-scores[found], kind="stable")]


def nearest_pivots(pivots, idf, mean):
    """Adds to each fragment its best two pivots and the first one's score; -1 where there is none."""
    def nearest(batches):
        index = Shard([Fragment(0, 0, 0, np.frombuffer(p, KIND)) for p in pivots], idf, mean)
        for batch in batches:
            near = np.full((2, batch.num_rows), -1, np.int32)
            top = np.zeros(batch.num_rows, np.float32)
            queries = [distinct(np.frombuffer(ids, KIND)) for ids in batch.column("ids").to_pylist()]
            for first in range(0, len(queries), ASKED_AT_ONCE):
                scores = index.scores_of(queries[first:first + ASKED_AT_ONCE])
                asker = np.arange(len(scores))
                for place in range(2):
                    best = scores.argmax(1)
                    score = scores[asker, best]
                    near[place, first + asker[score > 0]] = best[score > 0]
                    top[first + asker] = np.maximum(top[first + asker], score)
                    scores[asker, best] = 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near[0]), pa.array(near[1]), pa.array(top)],
                [*batch.schema.names, "near", "second", "score"])
    return nearest


def in_related_order(fragments, count, idf, mean):
    """The fragments in ranges of tasks, by their best pivots; a large group of like ones is split by a hash."""
    key = F.xxhash64("doc_id", "start", "ids")
    wanted = min(PIVOTS, -(-count // PIVOT_SHARE))
    share = min(1.0, (1.2 * wanted + 20) / max(count, 1))
    some = fragments.select("ids", key.alias("key")).filter(F.col("key") <= F.lit(int(-2**63 + share * (2**64 - 2048))))
    pivots = [bytes(r.ids) for r in some.orderBy("key").limit(wanted).collect()]
    if not pivots:
        return fragments
    near = written(fragments.mapInArrow(nearest_pivots(pivots, idf, mean), PLACED), "near-fragments")
    order = ["near", "second", "score", key]
    return near.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "start", "doc_tokens", "ids")


def placed(window, sequence, rows):
    """Add the pieces of one window to ``rows``."""
    offset = 0
    for fragment, ids in window:
        rows.append((fragment.doc_id, fragment.start, len(ids), checksum(ids), fragment.tokens, sequence, offset))
        fragment.start += len(ids)
        offset += len(ids)


def fill(shard, fragments):
    """Windows of a shard while it can fill them; yields lists of (fragment, ids)."""
    left = sum(len(f.ids) for f in fragments)
    oldest = 0
    while left >= WINDOW:
        while not shard.unused[oldest]:
            oldest += 1
        room, window = WINDOW, []

        def take(k):
            nonlocal room
            fragment = fragments[k]
            ids = fragment.ids[:room]
            window.append((fragment, ids))
            fragment.ids = fragment.ids[len(ids):]
            shard.unused[k] = len(fragment.ids) > 0
            room -= len(ids)

        take(oldest)
        if room:
            for k in shard.neighbours(oldest):
                take(k)
                if not room:
                    break
        rest = oldest
        while room:
            while not shard.unused[rest]:
                rest += 1
            take(rest)
        left -= WINDOW
        yield window


def packer(idf, mean):
    def pack(batches):
        part, number, waiting = TaskContext.get().partitionId(), 0, []
        for rows in in_blocks(batches, SHARD):
            columns = (rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
            waiting += [Fragment(d, s, n, np.frombuffer(i, KIND)) for d, s, n, i in zip(*columns)]
            out = []
            for window in fill(Shard(waiting, idf, mean), waiting):
                placed(window, (1 << 62) + (part << 32) + number, out)
                number += 1
            waiting = [f for f in waiting if len(f.ids)]
            yield piece_rows(out)
        left, out = sum(len(f.ids) for f in waiting), []
        for bit in range(left.bit_length() - 1, -1, -1):
            room, window = left & 1 << bit, []
            while room:
                fragment = next(f for f in waiting if len(f.ids))
                ids = fragment.ids[:room]
                window.append((fragment, ids))
                fragment.ids = fragment.ids[len(ids):]
                room -= len(ids)
            if window:
                placed(window, (1 << 62) + (part << 32) + number, out)
                number += 1
        yield piece_rows(out)
    return pack


def piece_rows(rows):
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 7)],
                                      list(names))


def packed(docs, vocabulary=VOCABULARY):
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parts = written(texts.mapInArrow(tokenizer(vocabulary), PARTS), "token-parts")
    counted = parts.filter("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "term_docs")).alias("t")).groupBy(
        F.col("t.terms").alias("term")).agg(F.sum("t.term_docs").alias("docs")).collect()
    n_docs = parts.filter("start + length = doc_tokens").count()
    idf = np.full(1 << 16, np.log1p(2.0 * n_docs + 1), np.float32)
    for term, docs_with in counted:
        idf[term] = np.log1p((n_docs - docs_with + 0.5) / (docs_with + 0.5))
    fragments = parts.filter("ids IS NOT NULL").select("doc_id", "start", "doc_tokens", "ids")
    count, mean = fragments.agg(F.count("*"), F.avg(F.length("ids") / KIND.itemsize)).first()
    related = in_related_order(fragments, count, idf, mean)
    whole = parts.filter("sequence_id IS NOT NULL").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(related.mapInArrow(packer(idf, mean), PIECES))
