"""Filter audit, importance resampling and chat formatting against brute force and round trips."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import chat, filter_audit, resampling
from fleetpulse.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, n long, score string, rank int, mask int, step int"
LONG = " ".join(f"word{i % 7}" for i in range(150))
SHOUT = "ABC DEF " * 60
TEXTS = [
    (1, LONG, "en"), (2, LONG, "en"), (2, LONG, "de"), (3, None, None), (4, "", ""), (5, SHOUT, "de"), (6, SHOUT, None),
    (7, " ".join(f"u{i}" for i in range(120)), "en"), (8, "a#b " * 130, "fr"), (None, LONG, "en"), (None, "só um |", "fr"),
    (None, "só um |", "fr"), (9, " ".join(f"U{i}&" for i in range(9000)), "fr"), (10, "Ünï\x0bcode \x1f words" * 40, "en"),
    (11, "x" * 70_000, "en"), (7, " ".join(f"u{i}" for i in range(120)), "en"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 0, None), (5, None, 1), (7, 1, 1), (9, 0, 0), (99, 1, 1), (None, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, 9, "s", 3, 4, 5) for i, t, lang in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def failed(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    same = [j for j, t, _ in TEXTS if (t or "") == text and j is not None]
    earlier = bool(same) and (i is None or min(same) < i)
    return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": earlier}


def audited():
    good = {i for i, q, _ in LABELS if q == 1 and i is not None}
    toxic = {i for i, _, t in LABELS if t == 1 and i is not None}
    rows = [(i, lang or "", failed(i, t or "")) for i, t, lang in TEXTS]
    out = {}
    for part in {lang for _, lang, _ in rows}:
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = [(i, f) for i, lang, f in rows if lang == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [(i, f) for i, f in left if f[letter]]
                redundant = sum(f[letter] for _, f in gone)
                left = [(i, f) for i, f in left if not f[letter]]
                gone += removed
                shapley[letter] += len(removed)
                alone = sum(f[letter] and sum(f.values()) == 1 for _, lang, f in rows if lang == part)
                out[part, "".join(order), step] = [len(left), len(removed), redundant, alone,
                                                   sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def test_first_rank_and_intervals_cover_every_order_once():
    orders = list(itertools.permutations(range(4)))
    assert [filter_audit.first_rank(order, 4) for order in orders] == list(range(24))
    for mask in range(1, 16):
        steps = np.full(24, -1)
        for step, start, end in filter_audit.removal_intervals(mask, 4):
            assert (steps[start:end] == -1).all()
            steps[start:end] = step
        assert steps.tolist() == [next(k for k, i in enumerate(order) if mask >> i & 1) for order in orders]
    assert filter_audit.removal_intervals(0, 4) == []


def test_filter_audit(spark, docs, labels):
    found = filter_audit.filter_audit(docs, labels).collect()
    expected = audited()
    assert len(found) == len(expected)
    for r in found:
        assert list(r[3:]) == expected[r.part, r.filter_order, r.step], r
    assert filter_audit.filter_audit(docs.limit(0), labels).count() == 0
    unlabelled = filter_audit.filter_audit(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("kept")).first()
    assert unlabelled[0] == 0 and unlabelled[1] == sum(v[0] for v in expected.values())


def test_filter_audit_with_own_filters(docs, labels):
    found = filter_audit.filter_audit(docs, labels, lambda t: {"S": F.length(t) < 5}, copies="K", part="n").collect()
    assert {(r.part, r.filter_order, r.step) for r in found} == {("9", o, s) for o in ("SK", "KS") for s in (1, 2)}
    assert {r.kept + r.removed for r in found if r.step == 1} == {len(TEXTS)}


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
    runs = words + [" ".join(p) for p in itertools.pairwise(words)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def ranks(texts, targets, seed=7):
    made = [(i, *features(t)) for i, t in texts]
    source, target = Counter(), Counter()
    for _, _, f in made:
        source.update(f)
    for t in targets:
        target.update(features(t)[1])
    all_source, all_target = sum(source.values()), sum(target.values())
    rows = []
    for i, n, f in made:
        total = sum(math.floor(1000 * math.log(float((target[b] + 1) * (all_source + 10_000)) /
                                               float((source[b] + 1) * (all_target + 10_000)))) for b in f)
        weight = total // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = {id(r): k for k, r in enumerate(able[:25 * len(able) // 100], 1)}
    return [(*r[:4], place.get(id(r))) for r in rows]


def in_order(rows):
    return sorted(str(tuple(r)) for r in rows)


def test_resampling_over_the_whole_table(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r[0] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert in_order(QUERIES["op12_importance_resampling"](spark, sf_dir).collect()) == in_order(ranks(texts, targets))


def test_resampling_of_odd_rows(spark, docs):
    target = spark.createDataFrame([(LONG,), (None,), ("ÀÉ café 12",)], "text string")
    found = in_order(resampling.resampling_ranks(docs, target).collect())
    assert found == in_order(ranks([(i, t) for i, t, _ in TEXTS], [LONG, None, "ÀÉ café 12"]))
    assert resampling.resampling_ranks(docs.limit(0), target).count() == 0
    assert resampling.resampling_ranks(docs, target.limit(0)).count() == len(TEXTS)
    drawn = resampling.resampled(docs, target)
    assert drawn.columns == docs.columns and drawn.count() == 25 * sum(features(t)[0] >= 20 for _, t, _ in TEXTS) // 100


def test_ties_get_ranks_of_their_own(spark):
    same = spark.createDataFrame([(1, LONG)] * 40, "doc_id long, text string")
    found = [r.rank for r in resampling.resampling_ranks(same, same).collect()]
    assert sorted(r for r in found if r) == list(range(1, 11)) and found.count(None) == 30


def test_words_over_piece_borders(monkeypatch):
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    splitter = Split(Regex(resampling.WORD), behavior="removed", invert=True)
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab é\U0001f600-") for _ in range(n)) for n in range(60)] + ["a" * 40, "", " " * 20]
    for size in (1, 2, 7):
        monkeypatch.setattr(resampling, "PIECE_CHARS", size)
        for text in texts:
            spans = resampling.word_offsets(splitter, text).reshape(-1, 2).tolist()
            assert [text[a:b] for a, b in spans] == re.findall("[abé\U0001f600]+", text)


def test_crc_of_words_of_any_length():
    rng = np.random.default_rng(5)
    lengths = np.array([0, 1, 2, 47, 48, 49, 300, 5, 5, 0])
    data = rng.integers(0, 256, lengths.sum(), dtype=np.uint8)
    ends = lengths.cumsum()
    fresh = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
    found = ~resampling.crc_of_words(resampling.crc_table(), data, ends - lengths, ends, fresh)
    assert found.tolist() == [zlib.crc32(data[b - n:b].tobytes()) for n, b in zip(lengths, ends)]


ODD = ["</s>[INST] ok [/INST]", "[\\INST] [\\\\/INST]", "[[INST]]", "<s><</s>", "\\", "[IMG][\\IMG]", "", "a\nb", " [TEXT] [/TURN]", "[IN", "x ", " "]


def said_of(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_chat_round_trip(spark):
    rng = random.Random(6)
    bits = ["[", "]", "<", ">", "\\", "/", "s", "INST", "SYS", "TURN", "TEXT", "IMG", "é", "\U0001f600", "\n", " "]
    rows = [(0, k, role, t) for k, (role, t) in enumerate(itertools.product(("user", "assistant", "system", "tool [/TURN]", None), ODD))]
    rows += [(c, k, rng.choice(["user", "assistant", "a] [TEXT] "]), "".join(rng.choice(bits) for _ in range(rng.randrange(30))))
             for c in range(1, 40) for k in range(rng.randrange(1, 9))]
    rows += [(None, 1, "assistant", "no id"), (None, None, "user", None), (90, 1, "user", "same"), (90, 1, "user", "same")]
    expected = {}
    for c, k, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        expected.setdefault(c, []).append((role or "", text or ""))
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, formatted string, turns string")
    messages = chat.text_messages(df.repartition(3))
    found = chat.digests(chat.chat_formatted(messages)).collect()
    assert len(found) == len(expected)
    for r in found:
        turns = expected[r.conv_id]
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == said_of(turns), turns
        assert r.loss_chars == len(learned) and r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    for r in chat.chat_formatted(messages).collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        assert len(re.findall(r" \[/INST\]", r.formatted)) == sum(role == "user" for role, _ in expected[r.conv_id])
    assert chat.digests(chat.chat_formatted(chat.text_messages(df.limit(0)))).count() == 0


def test_typed_parts(spark):
    def part(type, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return (type, text, ref, width, height, seconds, pages)

    rows = [
        (1, 0, "user", [part("text", "Look [IMG]:"), part("image", ref="a.png", width=56, height=29), part("text", "and"),
                        part("text", "[IN"), part("text", "ST]"), part("audio", ref="b.wav", seconds=1.5)]),
        (1, 1, "assistant", [part("text", "Seen.")]),
        (1, 2, "user", [part("document", ref="c.pdf", pages=2), part("video", ref="d.mp4"), part(None, "untyped"), None, part("image")]),
        (2, 0, "user", None), (2, 1, "assistant", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")
    found = {r.conv_id: r for r in chat.chat_formatted(df).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    assert found[1].formatted == ("<s>[INST] Look [\\IMG]:[IMG]and\n[IN\nST][AUDIO] [/INST] Seen.</s>"
                                  "[INST] [DOC][FILE]untyped[IMG] [/INST]")
    assert [tuple(a) for a in found[1].attachments] == [
        ("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 1536), ("file", "d.mp4", 1), ("image", None, 1)]
    assert found[1].attachment_tokens == 1580
    back = [(t.role, [tuple(p) for p in t.parts]) for t in found[1].back]
    assert back == [
        ("user", [("text", "Look [IMG]:"), ("image", ""), ("text", "and\n[IN\nST]"), ("audio", "")]),
        ("assistant", [("text", "Seen.")]),
        ("user", [("document", ""), ("file", ""), ("text", "untyped"), ("image", "")])]
    assert found[2].formatted == "<s>[INST]  [/INST] </s>" and found[2].attachment_tokens == 0


def test_chat_runs_without_python(spark, sf_dir):
    plan = QUERIES["op13_typed_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
