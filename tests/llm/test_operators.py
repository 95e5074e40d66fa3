"""Operators against brute force on small tables with nulls, repeats, ties and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetpulse.llm import (exact_dedup, extraction, golomb, hamming_search, mixing, near_dedup, packing, pii,
                            quality, sharding, substring_dedup)
from fleetpulse.llm.components import components

LINE = "the quick brown fox jumps over the lazy dog while nobody watches from the old stone bridge near town. "
NEAR = [f"w{i}" for i in range(120)]
TEXTS = [
    (1, LINE * 3), (2, LINE * 3), (3, "Intro. " + LINE + " outro"), (4, None), (5, ""), (6, "  \t "), (7, "one two"),
    (8, "ONE\ttwo"), (9, " ".join(NEAR)), (10, " ".join(NEAR[:60] + ["x"] + NEAR[61:])), (11, "é" * 90 + LINE),
    (12, " ".join(f"tok{i % 997}" for i in range(30_000))), (13, "mail a.b@c.org or 10.0.0.1, card 4111 1111 1111 1111"),
    (14, "+49 30 1234567 and a.b@c.org"), (None, LINE * 3), (2, LINE * 3), (15, "x" * 250), (16, "x" * 250),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, copy int, digest string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, ("a", "b", None)[k % 3], None, None, 9, "d") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_golomb_codes_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        values = np.unique(rng.integers(1000, 1 << 40, n, dtype=np.uint64))
        assert (golomb.decode(golomb.encode(values, 1000, 1 << 40), 1000) == values).all()


def test_exact_groups(docs, none):
    found = exact_dedup.exact_groups(docs, sender_rows=4).collect()
    plain = [re.sub("[ \t-\r]+", " ", t or "") for _, t in TEXTS]
    ids = defaultdict(list)
    for (i, _), t in zip(TEXTS, plain):
        ids[t].append(i)
    expected = sorted((str(i), min(x for x in ids[t] if x is not None), len(ids[t]),
                       hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(TEXTS, plain))
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)
    assert exact_dedup.exact_groups(none).count() == 0
    stay = exact_dedup.drop_exact_copies(docs)
    assert stay.columns == docs.columns and stay.count() == len(ids)


def near_expected():
    sets = {}
    for i, t in TEXTS:
        words = (t or "").encode().lower().split()
        n = min(5, len(words))
        sets[i] = {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set()
    return sets


def test_near_groups(docs, none):
    found = near_dedup.near_groups(docs).collect()
    sets = near_expected()
    assert len(found) == len(TEXTS)
    for r in found:
        near = [j for j, s in sets.items() if s and j is not None and sets[r.doc_id] and
                100 * len(s & sets[r.doc_id]) >= 85 * len(s | sets[r.doc_id])]
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == min(near or [r.doc_id])
    assert near_dedup.near_groups(none).count() == 0


def test_near_stage_drops_copies_from_eighty_percent_on(spark):
    words = [f"s{i}" for i in range(400)]
    other = [*words]
    for k in range(8):
        other[10 + 40 * k] = f"x{k}"
    pairs = len({*zip(*(words[k:] for k in range(5)))} & {*zip(*(other[k:] for k in range(5)))})
    assert 0.80 < pairs / (2 * 396 - pairs) < 0.85
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    assert [r.doc_id for r in near_dedup.drop_near_copies(df).collect()] == [1]
    assert near_dedup.near_groups(df).filter("kept").count() == 2


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_likelihood_finds_the_similarity():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 1 << 63, 1300, dtype=np.uint64) * np.uint64(2)
    table = np.stack([near_dedup.registers_of(items[:1000]), near_dedup.registers_of(items[60:1060])])
    kept, estimate = near_dedup.surviving(table, np.array([1000.0, 1000.0]), np.array([0]), np.array([1]))
    assert kept[0] and abs(estimate[0] - 940 / 1060) < 0.06
    merged = near_dedup.registers_of(items[:1060])
    assert (np.maximum(table[0], table[1]) == merged).all()


def test_repeated_substrings(docs, none):
    found = sorted((str(r[0]), *r[1:]) for r in substring_dedup.without_repeats(docs).collect())
    first, expected = {}, []
    order = sorted(TEXTS, key=lambda x: (x[0] is None, x[0] or 0))
    for i, t in order:
        raw = (t or "").encode()
        for p in range(len(raw) - 99):
            first.setdefault(raw[p:p + 100], (i, p))
    for i, t in order:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if first[raw[p:p + 100]] != (i, p):
                gone[p:p + 100] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()
        expected.append((str(i), len(raw), int(gone.sum()), runs, kept))
    assert found == sorted(expected)
    assert substring_dedup.without_repeats(none).count() == 0


@pytest.mark.parametrize("others", [None, 7])
def test_repeats_of_rows_without_an_id_of_their_own(spark, others):
    rng = np.random.default_rng(11)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = letters(130)
    rows = [(1, shared)] + [(others, letters(60 + k % 90) + (shared if k % 2 else letters(130)) + letters(k % 50))
                            for k in range(6000)]
    ids = [substring_dedup.LAST_ID - (xxhash.xxh64_intdigest(t, 42) & substring_dedup.HASHED_IDS - 1)
           if i is None else i for i, t in rows]
    first, expected = {}, []
    for i, (_, t) in zip(ids, rows):
        for p in range(len(t) - 99):
            first[t[p:p + 100]] = min(first.get(t[p:p + 100], (i, p)), (i, p))
    for i, (own, t) in zip(ids, rows):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 99):
            if first[t[p:p + 100]] != (i, p):
                gone[p:p + 100] = True
        kept = np.frombuffer(t.encode(), np.uint8)[~gone].tobytes()
        expected.append((own, len(t), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    found = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    held = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in found.collect()]
    assert sorted(held, key=str) == sorted(expected, key=str)


def test_packing(docs, none):
    found = packing.packed(docs).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    ids = {}
    for i, t in TEXTS:
        ids[i] = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected[i] += len(ids[i])
    found["doc_id"] = found.doc_id.astype(object).where(found.doc_id.notna(), None)
    totals = Counter()
    for r in found.itertuples():
        totals[r.doc_id] += r.length
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
    assert totals == expected
    for _, s in found.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]]
        size = s.length.sum()
        assert size <= 2048 and size & size - 1 == 0
    assert packing.packed(none).count() == 0


def test_special_token_text_is_the_tokenizers():
    text = "a<|endoftext|> b  c\n\n d"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.token_ids(packing.encoding(packing.VOCABULARY), text).tolist()
    assert own == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_retrieval_prefers_shared_rare_terms():
    idf = np.ones(1 << 16, np.float32)
    rows = [[5, 6, 7, 8], [9, 9, 9], [5, 6, 1], [1, 1]]
    shard = packing.Shard([packing.Fragment(i, 0, len(r), np.array(r, "<u2")) for i, r in enumerate(rows)], idf)
    assert [k for k in shard.neighbours(0) if k] == [2]


def test_retrieval_uses_all_ids_of_the_query():
    rng = np.random.default_rng(3)
    idf = rng.random(1 << 16).astype(np.float32)
    fragments = [packing.Fragment(i, 0, 60, rng.integers(0, 300, 60).astype("<u2")) for i in range(50)]
    shard = packing.Shard(fragments, idf)
    for seed in range(50):
        score = np.zeros(50)
        for k, f in enumerate(fragments):
            for t in set(f.ids.tolist()) & set(fragments[seed].ids.tolist()):
                n = (f.ids == t).sum()
                score[k] += idf[t] * n * 2.2 / (n + 1.2)
        assert np.allclose(shard.scores(np.unique(fragments[seed].ids).astype(np.int64)), score, rtol=1e-4)


def test_related_fragments_of_different_shards_meet(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 32)
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    topics = [["".join(rng.choice(letters, 7)) for _ in range(40)] for _ in range(4)]
    rows = [(i, " ".join(rng.choice(topics[i % 4], 60))) for i in range(480)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    windows = packing.packed(df).toPandas().groupby("sequence_id").doc_id
    mixed = [len(set(ids % 4)) for _, ids in windows if len(ids) > 1]
    assert sum(m == 1 for m in mixed) >= 0.8 * len(mixed)


def test_sharding(docs, none):
    found = sharding.sharded(docs, 4).toPandas()
    assert len(found) == len(TEXTS)
    sizes = Counter()
    for _, t in TEXTS:
        sizes[t or ""] += len((t or "").encode()) + 16
    by_crc = found.groupby("text_crc32")
    assert (by_crc.shard.nunique() == 1).all()
    assert found["size"].sum() == sum(sizes.values())
    for _, s in found.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
    assert sharding.sharded(none).count() == 0


def test_best_fit_takes_the_tightest_room():
    assert sharding.best_fit([(6, 1), (5, 1), (4, 1)], 2, 10) == [(6, 0, 1), (5, 1, 1), (4, 0, 1)]
    assert sharding.best_fit([(6, 3)], 2, 10) is None
    loads = Counter()
    for size, shard, n in sharding.even_plan([(1000, 1), (9, 10), (3, 7), (1, 100)], 4):
        loads[shard] += size * n
    assert loads[0] == 1000 and max(loads[s] for s in (1, 2, 3)) == -(-211 // 3)


def test_ties_and_a_group_above_an_even_share(spark):
    """Equal sizes in one class, a class of several groups, and one text with over half of all bytes."""
    rows = [(k, "h" * 500) for k in range(400)] + [(1000 + k, f"{k:09d}") for k in range(900)] + [(None, "t" * 9)] * 3
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8).toPandas()
    heavy = found[found["size"] == 516]
    assert len(found) == len(rows) and heavy.shard.nunique() == 1 and len(heavy) == 400
    home, loads = heavy.shard.iloc[0], found.groupby("shard")["size"].sum()
    assert loads[home] == 400 * 516  # it has the shard to itself
    others = loads.drop(home)
    assert len(others) == 7 and others.max() - others.min() <= 75  # the largest of the other groups
    assert found[found.doc_id.isna()].shard.nunique() == 1
    for _, s in found.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))


def test_mixing(docs, none):
    found = mixing.mixed(docs.drop("copy"), {"a": 1, "b": 3}).collect()
    assert {r.source for r in found} <= {"a", "b"}
    assert mixing.mixed(none).count() == 0
    assert mixing.replicated(docs).columns == docs.columns


def test_mixing_reaches_its_targets(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x" * 9).alias("text"),
                                    F.when(F.col("id") < 5000, "big").otherwise("small").alias("source"))
    counts = {r.source: r["count"] for r in mixing.mixed(rows).groupBy("source").count().collect()}
    assert abs(counts["big"] / 3000 - 1) < 0.06 and abs(counts["small"] / 3000 - 1) < 0.06


def test_search(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=20)]) for i in range(60)] + [
        (60, None), (61, []), (None, [1.0]), (62, [None, 1.0]), (1, [1.0] * 20), (63, [1.0] * 20), (64, [1.0] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {(r.vec_id, r["rank"]): (r.distance, r.neighbour_id) for r in hamming_search.nearest(
        df, F.col("vec_id") % 20 == 0, 5).collect()}
    codes = {(i, tuple(bool(x and x > 0) for x in [*v, *[0] * (20 - len(v))])) for i, v in rows if i is not None and v}
    for q, own in codes:
        if q % 20 == 0:
            best = sorted((sum(a != b for a, b in zip(own, c)), i) for i, c in codes if i != q)[:5]
            assert [found[q, k + 1] for k in range(5)] == best
    assert hamming_search.nearest(df.filter("vec_id < 0"), F.lit(True)).count() == 0


def test_search_in_shards_and_blocks(spark, monkeypatch):
    for name, value in (("SHARD_LEAST", 40), ("QUERY_BLOCK", 8), ("PROBES_AT_ONCE", 64)):
        monkeypatch.setattr(hamming_search, name, value)
    signs = np.random.default_rng(8).choice([-1.0, 1.0], (200, 70))
    signs[50:100] = signs[0]
    df = spark.createDataFrame([(i, "x", v.tolist()) for i, v in enumerate(signs)],
                               "vec_id long, code string, embedding array<double>")
    rows = hamming_search.nearest(df, F.col("vec_id") % 10 == 0, 12).collect()
    found = {(r.vec_id, r["rank"]): (r.distance, r.neighbour_id) for r in rows}
    for q in range(0, 200, 10):
        best = sorted((int((signs[q] != v).sum()), i) for i, v in enumerate(signs) if i != q)[:12]
        assert [found[q, k + 1] for k in range(12)] == best
    few = hamming_search.nearest(df.filter("vec_id < 3"), F.lit(True), 12).groupBy("vec_id").count().collect()
    assert sorted(tuple(r) for r in few) == [(0, 2), (1, 2), (2, 2)]


def test_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 1 << 40, (900, 1), dtype=np.uint64) & np.uint64((1 << 30) - 1), axis=0)
    ids = rng.permutation(len(codes))
    asked = codes[::45] ^ np.uint64(5)
    query, row, apart = hamming_search.MultiIndex(codes, 30).nearest(asked, 7, ids)
    for q, code in enumerate(asked):
        far = np.bitwise_count(codes[:, 0] ^ code[0])
        best = sorted(zip(far.tolist(), ids.tolist()))[:7]
        assert sorted(zip(apart[query == q].tolist(), ids[row[query == q]].tolist())) == best


def test_personal_data(docs, none):
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    row = found[13]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 0)
    assert row.base_sha256 == hashlib.sha256(b"email:5:14,ip:18:26,card:33:52").hexdigest()
    assert (found[14].n_phone, found[4].spans, found[5].base_sha256) == (1, "", hashlib.sha256(b"").hexdigest())
    assert pii.personal_data(none).count() == 0


@pytest.mark.parametrize("text, spans", [
    ("a@b.c@d.e", [(0, 0, 5)]), ("1.2.3.4.5.6.7.8", [(1, 0, 7), (1, 8, 15)]), ("300.1.1.1", []),
    ("9" * 40_000, []), ("a" * 40_000 + "@", []), ("+1 (555) 123-4567 x", [(3, 0, 17)]), ("@b.c", [])])
def test_base_spans(text, spans):
    assert pii.base_spans(text) == spans


def test_skip_links_make_labels_agree():
    graphs = [pii.graph("4111111111111111 x 4111-1111-1111-1111")]
    weights = np.zeros((pii.INPUTS, pii.LABELS))
    tables = np.zeros((2, pii.LABELS, pii.LABELS))
    tables[1] = np.eye(pii.LABELS) * 6
    own = pii.unpacked(graphs[0][1]) @ weights
    own[0, 3] += 6
    chances = pii.beliefs(own, np.array(graphs[0][3]), np.array([1]), tables)
    assert chances[1].argmax() == 3 and chances[1, 3] > 0.8


def test_main_text():
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>Menu</a></nav>
    <div class="sidebar"><p>A long side text that is no part of it. Really long, with full sentences.</p></div>
    <article><h1>Head &amp; line</h1><p>First <b>bo</b>ld   text.<br>Next</p><p>Second<script>x("<p>")</script>
    <div class="ad">Buy</div><form><input>Send</form></article>
    <div class="comments"><p>Great read, thank you very much for it. I liked all of it.</p></div><footer>f</footer></body>"""
    assert extraction.main_text(page, *extraction.prior()) == "Head & line First bold text. Next Second"
    for odd in ("", None, "<", "<p", "plain &lt;text", "<!-- open", "<a href='x"):
        extraction.main_text(odd, *extraction.prior())


@pytest.mark.parametrize("names, against", [
    ("content has-sidebar", False), ("content-sidebar-wrap", False), ("post with-comments", False), ("no-ads", False),
    ("page-header-fixed", False), ("sidebar-layout", False), ("sidebar", True), ("side-bar", True), ("sidebar-wrap", True),
    ("post_comments", True), ("related-posts", True), ("site-header-inner", True), ("comment-list", True)])
def test_layout_names_are_no_boilerplate(names, against):
    text = "A long plain paragraph of the article, with words enough and more. It has full sentences, too."
    page = f'<body><div class="{names}"><p>{text}</p><p>{text}</p></div></body>'
    assert extraction.main_text(page, *extraction.prior()) == ("" if against else f"{text} {text}")


def test_articles_in_marked_blocks_are_kept():
    text = "A long plain paragraph of the article, with words enough and more. It has full sentences, too."
    page = f"""<body><div class="header"><article><p>{text}</p><div class="comments"><article class="comment-body"><p>No.</p>
    </article></div></article></div></body>"""
    assert extraction.main_text(page, *extraction.prior()) == text
    nodes, _ = extraction.parse(page)
    assert [(n.tag, n.against) for n in nodes if n.tag in ("article", "p")] == [
        ("article", False), ("p", False), ("article", True), ("p", True)]


def test_messages_give_exact_marginals():
    rng = np.random.default_rng(2)
    parents, own, table = [-1, 0, 0, 1, 1, 2], rng.normal(size=6), rng.normal(size=(2, 2))
    barred = [False, False, False, True, False, False]
    total, each = 0.0, np.zeros(6)
    for k in range(64):
        y = [(k >> i) & 1 for i in range(6)]
        if not y[3]:
            w = np.exp(sum(o for o, v in zip(own, y) if v) + sum(table[y[parents[i]], y[i]] for i in range(1, 6)))
            total, each = total + w, each + w * np.array(y)
    assert np.allclose(extraction.marginals(parents, own, barred, table)[0], each / total)


def test_extraction_over_a_table(spark):
    rows = [(1, "u", "<article><p>Some text.</p></article>"), (1, "u", None), (None, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = sorted((str(r.page_id), r.text, r.n_chars) for r in extraction.main_texts(df).collect())
    assert found == [("1", "", 0), ("1", "Some text.", 10), ("None", "", 0)]
    assert extraction.main_texts(df.filter("false")).count() == 0


def test_sum_of_squares_identity():
    rng = np.random.default_rng(4)
    model = {"bias": 0.3, "mean": np.zeros(quality.STATS), "scale": np.ones(quality.STATS),
             "weights": rng.normal(size=40), "factors": rng.normal(size=(40, 3))}
    index, value = np.arange(0, 40, 2), rng.normal(size=20)
    pairs = sum(model["factors"][a] @ model["factors"][b] * x * y for k, (a, x) in enumerate(zip(index, value))
                for b, y in list(zip(index, value))[k + 1:])
    assert np.isclose(quality.score_logit(model, index, value), 0.3 + value @ model["weights"][index] + pairs)


def test_quality_without_labels_keeps_all(docs, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, labels).count() == len(TEXTS)
    assert quality.keep_good(none, labels).count() == 0
