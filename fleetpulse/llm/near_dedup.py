"""Near-duplicate documents by SetSketch registers.

1. A document's set is its distinct 5-word shingles, as 64-bit hashes of the whole text. Documents
   with equal sets are one class from here on; classes are told apart by 128 bits.
2. A register is the exponentially spaced, truncated minimum of an exponential hash over
   the set: floor(1 - log_b(min)), kept in [0, LIMIT]. Registers of a union are the larger
   of two, so they merge.
3. Bands of registers deal classes into buckets. A bucket is cut into blocks, and pairs of
   blocks are compared inside tasks: the counts of larger, equal and smaller registers give the
   joint likelihood of the similarity. A pair goes on unless the threshold's likelihood is
   exp(-DOUBT) of the best one's or less, and only from its first common band.
4. Survivors are verified on full sets, made anew from the whole texts.

Pairs are verified in two rounds. The first compares the members of each block among themselves
and with the bucket's first block, takes each one's likeliest partner, and links its findings to
components. The second takes every surviving pair that is not yet in one component, and deals
members by component, so that blocks of one component never meet. So a large group of near copies costs
comparisons and pairs in proportion to its members, and no link between different components is left out.

A link of similarity 0.85 misses all bands with a chance of about 2e-9 (0.8: 3e-6) and falls to
the likelihood with one of about 1e-6; everything after that is exact.

Null and empty texts, and those without words, have the empty set and are linked with
nothing. Rows that repeat a doc_id are documents of their own with that id. A null doc_id
counts as larger than any other. An empty table gives an empty result. Columns other than
doc_id and text are ignored.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import binaries, joined_evenly, mixed, release_shuffles, text_or_empty, written
from fleetpulse.llm.components import components

WORDS = 5
SHARE = 85  # percent, of the query
STAGE_SHARE = 80  # percent, of the pipeline's stage
REGISTERS = 512
BAND = 6
BANDS = 42  # of the first registers; all registers count for the likelihood
BASE, RATE, LIMIT = 1.02, 20.0, 4095
DOUBT = 12.0
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 256

_seeds = np.random.default_rng(20240229)
FACTORS = _seeds.integers(0, 1 << 32, (2, REGISTERS), dtype=np.uint32) | np.uint32(1)
PLACES = _seeds.integers(0, 1 << 63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GRID = np.linspace(0.0, 1.0, 101)

SKETCH = "row bigint, doc_id bigint, text_key bigint, n_shingles bigint, set_a bigint, set_b bigint, registers binary"


def shingles(text):
    """Sorted distinct hashes of the text's shingles."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64) * PLACES[WORDS]
    for k in range(width):
        total = mixed(total + hashed[k:k + count] * PLACES[k])
    return np.unique(total)


def registers_of(items):
    """SetSketch registers of a non-empty set of hashes; a hash has 32 bits for each register."""
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    lead = (items >> np.uint64(32)).astype(np.uint32)
    held = np.empty((ROWS_AT_ONCE, REGISTERS), np.uint32)
    for start in range(0, len(lead), ROWS_AT_ONCE):
        part = lead[start:start + ROWS_AT_ONCE, None]
        out = held[:len(part)]
        np.multiply(part, FACTORS[0], out=out)
        np.add(out, FACTORS[1], out=out)
        np.minimum(least, out.min(0), out=least)
    uniform = (least.astype(np.float64) + 1) / 2.0 ** 32
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-12)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, LIMIT).astype("<u2")


def set_key(items):
    """128 bits that stand for a set."""
    digest = xxhash.xxh3_128_digest(items.tobytes())
    return np.frombuffer(digest, "<i8")


def sketch_rows(batches):
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        out = []
        for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
            items = shingles(text)
            a, b = set_key(items).tolist()
            out.append((number, doc_id, key, len(items), a, b, registers_of(items).tobytes() if len(items) else None))
            number += 1
        columns = list(zip(*out)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns[:6]], binaries(columns[6])],
            ["row", "doc_id", "text_key", "n_shingles", "set_a", "set_b", "registers"])


def band_rows(batches):
    for batch in batches:
        table = np.frombuffer(b"".join(batch.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        keys = band_keys(table)
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys.ravel().view(np.int64))], ["node", "band"])


def band_keys(table):
    """One 64-bit key for each band of each row of registers."""
    parts = table[:, :BANDS * BAND].reshape(-1, BANDS, BAND).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(BAND):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k] + np.uint64(1))
    return keys


def log_likelihood(more, less, equal, u, v, similarity):
    """Of register counts for sets with shares u and v of their summed sizes."""
    scale = (BASE - 1) / BASE
    step = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * scale) / math.log(BASE)
    p, q = step(u - v * similarity), step(v - u * similarity)
    return more * np.log(p) + less * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, 1))


def surviving(table, sizes, a, b, share=SHARE):
    """Which of the pairs the threshold may still hold for, and their likeliest similarities."""
    same = (table[a] == table[b]).sum(1)
    more = (table[a] > table[b]).sum(1)
    less = REGISTERS - same - more
    u = sizes[a] / (sizes[a] + sizes[b])
    v = 1 - u
    top = np.minimum(u / v, v / u)
    best, estimate = np.full(len(a), -np.inf), np.zeros(len(a))
    for x in GRID:
        found = np.where(x <= top, log_likelihood(more, less, same, u, v, x), -np.inf)
        better = found > best
        best[better], estimate[better] = found[better], x
    at = log_likelihood(more, less, same, u, v, np.minimum(share / 100, top))
    return (estimate >= share / 100) | (at > best - DOUBT), estimate


def compared(rows, first_round, share):
    """Of whole groups (band, i, j) of rows: the pairs of nodes that go on to verification."""
    band, i, j, side, node, held = (rows.column(c).to_numpy() for c in ("band", "i", "j", "side", "node", "held"))
    table = np.frombuffer(b"".join(rows.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
    sizes = rows.column("n_shingles").to_numpy().astype(np.float64)
    keys = band_keys(table)
    place = (keys.view(np.int64) == band[:, None]).argmax(1)
    count = len(band)
    starts = group_starts(band, i, j)
    ends = np.repeat(np.append(starts[1:], count), np.diff(np.append(starts, count)))
    rights = np.add.reduceat(side, starts)
    first_right = ends - np.repeat(rights, np.diff(np.append(starts, count)))
    low = np.where(i == j, np.arange(count) + 1, np.where(side == 0, first_right, ends))
    found_a, found_b = [], []
    upto = np.cumsum(ends - low)
    cuts = np.searchsorted(upto, np.arange(PAIRS_AT_ONCE, upto[-1], PAIRS_AT_ONCE)) if count else []
    for part in np.split(np.arange(count), cuts):
        widths = ends[part] - low[part]
        a = np.repeat(part, widths)
        b = np.arange(len(a)) - np.repeat(np.cumsum(widths) - widths, widths) + np.repeat(low[part], widths)
        kept = 100 * np.minimum(sizes[a], sizes[b]) >= share * np.maximum(sizes[a], sizes[b])
        if not first_round:
            kept &= held[a] != held[b]
        a, b = a[kept], b[kept]
        kept = (keys[a] == keys[b]).argmax(1) == place[a]
        a, b = a[kept], b[kept]
        kept, estimate = surviving(table, sizes, a, b, share)
        a, b, estimate = a[kept], b[kept], estimate[kept]
        if first_round and len(a):
            own, other, score = np.append(a, b), np.append(b, a), np.append(estimate, estimate)
            order = np.lexsort((-score, own))
            own, other = own[order], other[order]
            kept = np.diff(own, prepend=-1) != 0
            a, b = own[kept], other[kept]
        found_a.append(node[a])
        found_b.append(node[b])
    a, b = np.concatenate(found_a or [node[:0]]), np.concatenate(found_b or [node[:0]])
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def group_starts(*columns):
    """Where a run of equal rows begins."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(changed)


def block_pairs(first_round, share):
    """Compares the blocks of sorted rows group by group; a group is at most two blocks."""
    def compare(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables(
                [held, pa.Table.from_batches([batch])])
            last = group_starts(*(rows.column(c).to_numpy() for c in ("band", "i", "j")))[-1:]
            if len(last) and last[0]:
                yield compared(rows.slice(0, last[0]), first_round, share)
                rows = rows.slice(last[0])
            held = rows.combine_chunks()
        if held is not None and held.num_rows:
            yield compared(held, first_round, share)
    return compare


def paired(members, partners):
    """Members once for each pair of blocks (i, j) that they are to be compared in; ``partners`` gives the others' blocks."""
    return members.withColumn("other", F.explode(partners)).select(
        "*", F.least("other", "block").alias("i"), F.greatest("other", "block").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"))


def first_blocks(buckets):
    """Each block meets itself and the bucket's first block.

    The number of blocks is a power of two, so that members of one block of a bucket share one in every smaller
    bucket, too.
    """
    dealt = buckets.withColumn("blocks", F.expr(f"shiftleft(1, greatest(0, cast(ceil(log2(size / {BLOCK})) as int)))")
                               ).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return paired(dealt.withColumn("held", F.lit(0).cast("long")),
                  F.expr("if(block = 0, sequence(0, blocks - 1), array(0, block))"))


def cross_blocks(buckets, held):
    """Blocks of the buckets that hold several components; two blocks of one large component do not meet.

    A component with more than a block's members in a bucket has blocks of its own, the other members share some.
    """
    members = written(buckets.select("node", "band").join(held, "node"), "held-members")
    cells = written(members.groupBy("band", "held").agg(F.count("*").alias("m")), "held-cells").withColumn(
        "own", F.when(F.col("m") > BLOCK, F.ceil(F.col("m") / BLOCK)).otherwise(0).cast("int"))
    bands = written(cells.groupBy("band").agg(
        F.ceil(F.sum(F.when(F.col("own") == 0, F.col("m")).otherwise(0)) / BLOCK).cast("int").alias("shared"),
        F.sum("own").cast("int").alias("owned"), F.sum("m").alias("n"), F.min("held").alias("lo"),
        F.max("held").alias("hi")).filter("lo <> hi").drop("lo", "hi"), "held-bands")
    before = Window.partitionBy("band").orderBy("held").rowsBetween(Window.unboundedPreceding, -1)
    large = cells.filter("own > 0").select(
        "band", "held", "own", F.coalesce(F.sum("own").over(before), F.lit(0)).cast("int").alias("before"))
    dealt = joined_evenly(members, bands, "band").join(large, ["band", "held"], "left").withColumns({
        "start": F.col("shared") + F.col("before"), "blocks": F.col("shared") + F.col("owned")})
    placed = dealt.withColumn("block", F.coalesce(
        F.col("start") + F.pmod(F.xxhash64("node"), F.col("own")), F.pmod(F.xxhash64("node"), F.col("shared"))).cast("int"))
    return paired(placed, F.expr(
        "filter(sequence(0, blocks - 1), o -> own is null or o < start or o >= start + own)"))


def candidates(buckets, classes, share, held=None):
    """Distinct pairs (a, b) of nodes for verification; with ``held`` only across components."""
    rows = first_blocks(buckets) if held is None else cross_blocks(buckets, held)
    sorted_rows = rows.select("band", "i", "j", "side", "node", "held").join(classes, "node").repartition(
        "band", "i", "j").sortWithinPartitions("band", "i", "j", "side").select(
        "band", "i", "j", "side", "node", "held", "n_shingles", "registers")
    pairs = sorted_rows.mapInArrow(block_pairs(held is None, share), "a bigint, b bigint")
    return written(pairs.distinct(), "near-pairs")


def linked_rows(share):
    def linked(batches):
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                x, y = shingles(x), shingles(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * both >= share * (len(x) + len(y) - both))
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])
    return linked


def verified(pairs, nodes, texts, share):
    """The pairs whose full sets are similar enough; ``nodes`` has each class's doc_id and key."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    keyed = wanted.join(nodes, "node")
    found = texts.withColumnRenamed("doc_id", "__id").join(
        keyed, F.col("__id").eqNullSafe(F.col("doc_id"))).select("node", "set_a", "set_b", "text")
    own = found.mapInArrow(own_text_rows, "node bigint, text string").groupBy("node").agg(
        F.min("text").alias("text"))
    own = written(own, "pair-texts")
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        own.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    links = both.select("a", "b", "text_a", "text_b").mapInArrow(linked_rows(share), "a bigint, b bigint")
    return written(links, "near-links")


def own_text_rows(batches):
    """Drops texts of other rows that repeat a class's doc_id."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        keys = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
        same = [tuple(set_key(shingles(t)).tolist()) == k for t, k in zip(texts, keys)]
        yield batch.filter(pa.array(same, pa.bool_())).select(["node", "text"])


def grouped_rows(docs, share):
    """doc_id, text_key, n_shingles and group of each document, as a written table."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    keyed = texts.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = written(keyed.mapInArrow(sketch_rows, SKETCH), "sketches")
    firsts = written(rows.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(
        F.min("row").alias("node"), F.count("*").alias("n")), "set-firsts")
    classes = written(rows.join(firsts.select(F.col("node").alias("row")), "row").select(
        F.col("row").alias("node"), "doc_id", "n_shingles", "set_a", "set_b", "registers"), "set-classes")
    release_shuffles(spark)

    bands = written(classes.select("node", "registers").mapInArrow(band_rows, "node bigint, band bigint"), "bands")
    shared = written(bands.groupBy("band").agg(F.count("*").alias("n"), F.count("*").alias("size")).filter("n > 1"),
                     "shared-bands")
    buckets = written(joined_evenly(bands, shared, "band"), "buckets")
    sketches = classes.select("node", "n_shingles", "registers")
    nodes = classes.select("node", "doc_id", "set_a", "set_b")
    release_shuffles(spark)

    likely = verified(candidates(buckets, sketches, share), nodes, texts, share)
    found = written(components(likely), "near-components")
    release_shuffles(spark)
    held = buckets.select("node").distinct().join(found, "node", "left").select(
        "node", F.coalesce("component", "node").alias("held"))
    rest = verified(candidates(buckets, sketches, share, written(held, "near-held")), nodes, texts, share)
    release_shuffles(spark)
    links = likely.unionByName(rest)
    ends = written(components(links), "near-components")

    # a class's component is named by its smallest node; documents want the smallest doc_id
    named = written(firsts.join(ends, "node", "left").select(
        "set_a", "set_b", "n", F.coalesce("component", "node").alias("group")), "near-names")
    own = ("doc_id", "text_key", "n_shingles")
    filled = rows.filter("n_shingles > 0").select(*own, "set_a", "set_b")
    return written(joined_evenly(filled, named, ("set_a", "set_b")).select(*own, "group").unionByName(
        rows.filter("n_shingles = 0").select(*own, F.col("row").alias("group"))), "near-members")


def near_groups(docs, share=SHARE):
    """doc_id, n_shingles, component_id, kept of each document; links from ``share`` percent on."""
    member = grouped_rows(docs, share)
    smallest = written(member.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")),
                       "near-smallest")
    return joined_evenly(member, smallest, "group").select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs, share=STAGE_SHARE):
    """The rows of ``docs`` that stay, one for each group, with all their columns.

    The smallest doc_id stays, one without an id only where no row has any.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    stay = grouped_rows(docs, share).groupBy("group").agg(first).select(
        F.col("first.doc_id").alias("__stay"), F.col("first.text_key").alias("__key"))
    kept = docs.withColumn("__own", F.xxhash64(text_or_empty())).join(
        stay, F.col("doc_id").cast("long").eqNullSafe(F.col("__stay")) & (F.col("__own") == F.col("__key")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__own"]).drop("__own")
