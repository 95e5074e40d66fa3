"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code is the signs of its numbers. The different codes are dealt by hash into shards
of a bounded size, and every query meets every shard, in blocks of queries. A task indexes
its shard: codes are cut into segments of about log2(shard size) bits, each with a table from
value to codes. Round r looks up, in every segment, the values at distance r from the
query's. A code not met up to round r differs by more than r in each of the m segments, so
it is at least m * (r + 1) away: a query is done when its k-th verified distance is below that,
and only open queries go on. The nearest of all shards are then merged.

The work grows with queries times shards; a shard holds ``SHARD_BITS`` bits of codes once there
are more than ``SPREAD`` shards.

Equal codes are one entry with their k + 1 smallest ids, which suffices for k neighbours.
Ties go to the smaller id. A query's own id is no neighbour of it. Rows with a null or
empty vector, or a null id, are left out; missing or null numbers have bit 0. Repeated
rows count once. An empty table gives an empty result.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.llm.common import written

WORD_BITS = 16
SHARD_BITS = 1 << 26
SPREAD, SHARD_LEAST = 64, 1 << 13
QUERY_BLOCK = 1 << 19
QUERIES_AT_ONCE = 256
PROBES_AT_ONCE = 1 << 20


def with_codes(vectors, words):
    bit = f"if(get(embedding, j * {WORD_BITS} + b) > 0, shiftleft(1, b), 0)"
    return vectors.filter("vec_id IS NOT NULL AND size(embedding) > 0").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.expr(f"""transform(sequence(0, {words - 1}), j -> aggregate(
            sequence(0, {WORD_BITS - 1}), 0, (a, b) -> a + {bit}))""").alias("code")).distinct()


def first_ids(rows, keys, order, count):
    """The first ``count`` rows of each key; Spark cuts each key to them before the shuffle too."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", rank).filter(F.col("__rank") <= count).drop("__rank")


def code_words(column):
    """A column of code arrays as rows of 64-bit words."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype("<u2").reshape(len(column), -1).view("<u8")


class MultiIndex:
    """The codes of a shard by the values of their segments."""

    def __init__(self, codes, bits):
        self.codes = codes
        width = max(1, min(round(math.log2(len(codes))), bits))
        self.parts = np.array_split(np.arange(bits), -(-bits // width))
        self.tables = []
        for values, part in zip(self.segments(codes), self.parts):
            ends = np.cumsum(np.bincount(values, minlength=1 << len(part)))
            self.tables.append((np.argsort(values, kind="stable"), np.append(0, ends)))

    def segments(self, codes):
        flat = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little")
        return [flat[:, part].astype(np.int64) @ (1 << np.arange(len(part))) for part in self.parts]

    def hits(self, values, part, table, radius):
        """(query, code) pairs whose values of one segment differ in ``radius`` bits."""
        order, offsets = table
        every = np.arange(1 << len(part))
        flips = every[np.bitwise_count(every) == radius]
        step = max(1, PROBES_AT_ONCE // max(1, len(flips)))
        for start in range(0, len(values), step):
            probes = values[start:start + step, None] ^ flips
            low = offsets[probes]
            size = offsets[probes + 1] - low
            query, probe = np.nonzero(size)
            low, size = low[query, probe], size[query, probe]
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield np.repeat(query + start, size), order[np.repeat(low, size) + inner]

    def nearest(self, asked, count, smallest_id):
        """(query, code, distance) of the ``count`` nearest codes of each query, ties by id."""
        values = self.segments(asked)
        still, kth = np.arange(len(asked)), np.full(len(asked), np.iinfo(np.int64).max)
        query = row = apart = np.empty(0, np.int64)
        for radius in range(max(map(len, self.parts)) + 1):
            for mine, part, table in zip(values, self.parts, self.tables):
                for q, r in self.hits(mine[still], part, table, radius):
                    q = still[q]
                    far = np.bitwise_count(asked[q] ^ self.codes[r]).sum(1, dtype=np.int64)
                    near = far <= kth[q]
                    query, row, apart = (np.append(a, b[near]) for a, b in
                                         ((query, q), (row, r), (apart, far)))
            _, once = np.unique(query * len(self.codes) + row, return_index=True)
            once = once[np.lexsort((smallest_id[row[once]], apart[once], query[once]))]
            query, row, apart = query[once], row[once], apart[once]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            query, row, apart = query[rank < count], row[rank < count], apart[rank < count]
            last = rank[rank < count] == count - 1
            kth[query[last]] = apart[last]
            still = still[kth[still] >= len(self.parts) * (radius + 1)]
            if not len(still):
                break
        return query, row, apart


def shard_search(bits, count):
    def search(index, queries):
        found = []
        if index.num_rows and queries.num_rows:
            codes, asked = code_words(index["code"]), code_words(queries["query"])
            ids = index["ids"].combine_chunks()
            flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
            shard = MultiIndex(codes, bits)
            for start in range(0, len(asked), QUERIES_AT_ONCE):
                query, row, apart = shard.nearest(
                    asked[start:start + QUERIES_AT_ONCE], count, flat[offsets[:-1]])
                size = offsets[row + 1] - offsets[row]
                inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                found.append((np.repeat(query + start, size), flat[np.repeat(offsets[row], size) + inner],
                              np.repeat(apart, size)))
        query, neighbour, apart = (np.concatenate(c) for c in zip(*found)) if found else [np.empty(0, np.int64)] * 3
        return pa.table({"query": queries["query"].take(pa.array(query)), "neighbour_id": pa.array(neighbour),
                         "distance": pa.array(apart.astype(np.int32))})
    return search


def nearest(vectors, is_query, k=10):
    """vec_id, rank, neighbour_id, distance: the k nearest of each query row."""
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0]
    bits = max(1, longest or 1)
    coded = written(with_codes(vectors, 4 * -(-bits // 64)), "codes")
    entries = written(first_ids(coded, ["code"], ["vec_id"], k + 1).groupBy("code").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")), "code-entries")
    queries = coded.filter(is_query).select("vec_id", F.col("code").alias("query"))
    asked = written(queries.select("query").distinct(), "queries")
    size, asking = entries.count(), asked.count()
    shards = max(1, -(-size * bits // SHARD_BITS), min(SPREAD, -(-size // SHARD_LEAST)))
    blocks = max(1, -(-asking // QUERY_BLOCK))

    def dealt(rows, shard, block):
        return rows.withColumn("shard", shard).withColumn("block", block).repartition(
            shards * blocks, "shard", "block").groupBy("shard", "block")

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def one_of(n, column):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    hits = dealt(entries, one_of(shards, "code"), each(blocks)).cogroup(
        dealt(asked, each(shards), one_of(blocks, "query"))).applyInArrow(
        shard_search(bits, k + 1), "query array<int>, neighbour_id bigint, distance int")
    found = first_ids(written(hits, "shard-hits"), ["query"], ["distance", "neighbour_id"], k + 1)
    pairs = queries.join(found, "query").filter("neighbour_id != vec_id").drop("query")
    rank = F.row_number().over(W.partitionBy("vec_id").orderBy("distance", "neighbour_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "vec_id", "rank", "neighbour_id", "distance")


ORACLE = """
WITH codes AS (SELECT DISTINCT vec_id, [x > 0 FOR x IN embedding] AS bits
               FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
pairs AS (SELECT q.vec_id, c.vec_id AS neighbour_id,
                 len([p FOR p IN list_zip(q.bits, c.bits) IF p[1] <> p[2]])::INT AS distance
          FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT vec_id, rank::INT AS rank, neighbour_id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour_id) AS rank FROM pairs)
WHERE rank <= 10
"""
