"""The pipeline against plain Python on a small table, and stages on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fleetpulse.llm import exact_dedup, mixing, near_dedup, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def prose(rng, n):
    words = [rng.choice(["river", "stone", "light", "garden", "walks", "slowly", "over", "the", "old", "bridge"]) + str(rng.randrange(60))
             for _ in range(n)]
    return " ".join(words).capitalize() + "."


def planted():
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randrange(40, 160)), "hot" if i % 3 else f"s{i % 5}") for i in range(90)]
    rows += [(200 + i, "BUY $$$ NOW!!! " * rng.randrange(5, 40) + f"@@{i} ###", "hot") for i in range(40)]
    texts = dict((i, t) for i, t, _ in rows)
    rows += [(300 + i, texts[i].replace(" ", "\n ", 3), "copies") for i in range(12)]
    rows += [(400 + i, " ".join(w if k != 20 else f"new{i}" for k, w in enumerate(texts[i].split())), "near") for i in range(12, 24)]
    rows += [(500, None, None), (501, "", "empty"), (None, texts[30], "none"), (None, "Only here " + texts[31], "none"), (7, texts[7], "hot")]
    labels = [(i, int(i < 200), 0) for i, _, _ in rows[:130] if i % 2]
    return [(i, t, "en", s, len(t or "")) for i, t, s in rows], labels


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    return {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def id_key(row):
    return row[0] is None, row[0] or 0


def exact_stage(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row)
    return [min(g, key=id_key) for g in groups.values()]


def near_stage(rows):
    sets, left, kept = [shingle_set(r[1]) for r in rows], set(range(len(rows))), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            a = todo.pop()
            group.add(a)
            near = [b for b in left if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            left -= set(near)
            todo += near
        kept.append(min((rows[k] for k in group), key=id_key))
    return kept


def poisson_copies(row, rate):
    parts = max(math.ceil(rate / mixing.PART_MEAN), 1)
    mean, total = rate / parts, 0
    for part in range(1, parts + 1):
        name = "null" if row[0] is None else row[0]
        u = int(hashlib.md5(f"count{mixing.SEED}:{name}:{part}".encode()).hexdigest()[:13], 16) / 2 ** 52
        cdf = np.cumsum([math.exp(-mean) * mean ** k / math.factorial(k) for k in range(mixing.CDF_STEPS + 1)])
        total += int((cdf <= u).sum())
    return total


def mixing_stage(rows):
    sizes = Counter()
    for row in rows:
        sizes[row[3]] += len(row[1] or "") + 1
    whole = sum(sizes.values())
    return [row for row in rows for _ in range(poisson_copies(row, whole / len(sizes) / sizes[row[3]]))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = planted()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path


def test_run_equals_plain_python(spark, folder):
    rows, _ = planted()
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    score = lambda text: 1 / (1 + math.exp(-quality.score_logit(model, *quality.inputs(text))))
    kept = [r for r in rows if score(r[1]) >= quality.THRESHOLD]
    assert {i for i, *_ in kept if i is not None and 200 <= i < 240} == set() and len(kept) > 80
    kept = near_stage(exact_stage(kept))
    assert not {i for i, *_ in kept if i is not None and 300 <= i < 500}
    copies = mixing_stage(kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = Counter()
    for row in copies:
        tokens[row[0], len(tokenizer.encode(row[1] or "", add_special_tokens=False).ids) + 1] += 1

    pieces = corpus_pipeline.run(spark, folder).collect()
    found, windows, crcs = Counter(), defaultdict(list), defaultdict(set)
    for p in pieces:
        found[p.doc_id, p.doc_tokens] += p.length
        windows[p.sequence_id].append((p.offset, p.length))
        crcs[p.doc_id, p.doc_tokens, p.start, p.length].add(p.ids_crc32)
    assert found == Counter({key: n * key[1] for key, n in tokens.items()})
    assert Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == tokens
    for spans in windows.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        size = sum(n for _, n in spans)
        assert size == 2048 or size & (size - 1) == 0
    assert all(len(c) == 1 for key, c in crcs.items() if key[0] is not None)


def test_the_model_does_not_depend_on_the_layout(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scores = [sorted(map(tuple, quality.quality_scores(d, m).select("doc_id", "score").collect())) for d, m in (
        (docs, labels), (docs.repartition(7), labels.repartition(3)), (docs.orderBy("text"), labels.orderBy("quality")))]
    assert scores[0] == scores[1] == scores[2]


def test_training_rows_are_bounded_when_ids_repeat(spark):
    docs = spark.createDataFrame([(1, f"text number {i}") for i in range(300)] + [(1, "same")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, quality int")
    seen = []
    fit, quality.fit = quality.fit, lambda rows: seen.append(rows)
    try:
        quality.train(docs, labels, train_rows=40)
    finally:
        quality.fit = fit
    assert len(seen[0]) == 40


ODD = [(5, "A"), (None, "A"), (None, "B"), (7, "C x"), (7, "C  x"), (None, None), (8, ""), (None, "B")]


def test_exact_stage_leaves_no_copies(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    found = exact_dedup.drop_exact_copies(docs).collect()
    assert Counter((r.doc_id, re.sub(r"\s+", " ", r.text or "")) for r in found) == Counter(
        [(5, "A"), (None, "B"), (7, "C x"), (8, "")])
    assert exact_dedup.drop_exact_copies(docs.limit(0)).count() == 0


def test_near_stage_leaves_no_copies(spark):
    words = [f"w{i}" for i in range(200)]
    close = " ".join(words[:100] + ["other"] + words[101:])
    rows = [(None, " ".join(words)), (None, close), (None, "something else entirely here now"), (3, " ".join(words).upper()),
            (3, "a text of its own with the same number")]
    found = near_dedup.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted(
        [("None", rows[2][1]), ("3", rows[3][1]), ("3", rows[4][1])])


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name
