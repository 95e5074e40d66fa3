"""Large families of near copies, hot keys, and links that the sketches must not lose."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import near_dedup
from fleetpulse.llm.common import joined_evenly


def family(n, seed=1, words=160):
    """Texts that differ from one base in a single word near the end."""
    rng = random.Random(seed)
    base = [f"f{seed}w{k}" for k in range(words)]
    return [" ".join([*base[:-1 - (k % 3)], f"own{seed}x{k}", *(base[-(k % 3):] if k % 3 else [])]) for k in range(n)]


def shingle_sets(texts):
    return [frozenset(zip(*(t.lower().split()[k:] for k in range(5)))) for t in texts]


def brute_components(texts, share):
    sets, root = shingle_sets(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def test_components_equal_brute_force_over_many_blocks(spark, monkeypatch):
    """Families larger than a block, strays of middling similarity, copies and empty texts."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(3)
    texts = family(60) + family(45, seed=2)
    for t in family(40, seed=1) + family(25, seed=2):
        words = t.split()
        for k in rng.sample(range(len(words)), rng.randint(1, 6)):
            words[k] = f"z{rng.random()}"
        texts.append(" ".join(words))
    texts += texts[:10] * 3 + [" ".join(f"s{k}v{j}" for j in range(30)) for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(10_000 + k, None) for k in range(30)],
                                 "doc_id long, text string").repartition(4)
    for share in (85, 80):
        found = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, share).collect()}
        expected = brute_components(texts, share)
        assert len(found) == len(texts) + 30
        assert {k: found[k] for k in range(len(texts))} == dict(enumerate(expected))
        assert all(found[10_000 + k] == 10_000 + k for k in range(30))


def comparisons(rows):
    """Pairs that the tasks look at in the groups of ``rows``."""
    sides = rows.groupBy("band", "i", "j").agg(F.sum("side").alias("right"), F.count("*").alias("n"))
    return sides.agg(F.sum(F.expr("if(i = j, n * (n - 1) / 2, right * (n - right))"))).first()[0] or 0


def buckets_of(spark, n, components):
    """One bucket of ``n`` members in (a large and some small) components."""
    rows = spark.range(n).select(F.col("id").alias("node"), F.lit(5).cast("long").alias("band"), F.lit(n).alias("size"))
    held = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") < components, F.col("id")).otherwise(
        n).alias("held"))
    return rows, held


@pytest.mark.parametrize("n", [20_000])
def test_comparisons_grow_with_the_family(spark, n):
    small, large = (buckets_of(spark, m, 12) for m in (n, 2 * n))
    first = [comparisons(near_dedup.first_blocks(b)) for b, _ in (small, large)]
    cross = [comparisons(near_dedup.cross_blocks(*both)) for both in (small, large)]
    assert first[1] < 2.3 * first[0] and first[0] < 2.5 * n * near_dedup.BLOCK
    assert cross[1] < 2.1 * cross[0] and cross[0] < 13 * n


def test_cross_blocks_meet_every_pair_of_components(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = random.Random(9)
    held = {k: rng.choice([0, 0, 0, 1, 1, 1, 2, *range(3, 20)]) for k in range(120)}
    buckets = spark.createDataFrame([(k, b, 60) for k in held for b in (k % 2, 7)], "node long, band long, size long")
    rows = near_dedup.cross_blocks(buckets, spark.createDataFrame(list(held.items()), "node long, held long")).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.band, r.i, r.j), []).append(r)
    met = Counter()
    for (band, i, j), members in groups.items():
        for x in members:
            for y in members:
                if x.held < y.held and (i == j or x.side != y.side):
                    met[band, x.node, y.node] += 1
    wanted = {(b, x, y) for x in held for y in held if held[x] < held[y] for b in (0, 1, 7) if
              b == 7 or x % 2 == y % 2 == b}
    assert set(met) == wanted and set(met.values()) == {1}


@pytest.mark.parametrize("low, share", [(0.85, 85), (0.80, 80)])
def test_planted_links_reach_verification(low, share):
    """4,000 pairs at most 0.02 above the threshold: none misses the bands, none the likelihood."""
    rng = np.random.default_rng(int(100 * low))
    bands, likely, n, size = 0, 0, 4000, 200
    for _ in range(n):
        similarity = low + 0.02 * rng.random()
        both = int(np.ceil(2 * size * similarity / (1 + similarity)))
        items = rng.integers(0, 1 << 64, 2 * size - both, dtype=np.uint64)
        table = np.stack([near_dedup.registers_of(items[:size]), near_dedup.registers_of(items[-size:])])
        keys = near_dedup.band_keys(table)
        bands += not (keys[0] == keys[1]).any()
        kept, _ = near_dedup.surviving(table, np.array([size, size], float), np.array([0]), np.array([1]), share)
        likely += not kept[0]
    assert (bands, likely) == (0, 0)


def test_hot_keys_join_by_broadcast(spark):
    rows = spark.createDataFrame([(0, k) for k in range(500)] + [(k, k) for k in range(1, 60)], "key long, x long")
    folded = rows.groupBy("key").agg(F.max("x").alias("top"), F.count("*").alias("n"))
    found = joined_evenly(rows, folded, "key")
    expected = {(0, k, 499) for k in range(500)} | {(k, k, k) for k in range(1, 60)}
    assert found.columns == ["key", "x", "top"] and {tuple(r) for r in found.collect()} == expected
    assert found.count() == 559
    assert joined_evenly(rows.filter("key < 0"), folded.filter("key < 0"), "key").count() == 0
