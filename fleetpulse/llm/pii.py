"""Personal data by base patterns and a skip-chain conditional random field.

Base spans are the leftmost non-overlapping matches of a pattern per kind; matches that
fail their kind's test are dropped. They are found in one pass each, without
retries, so that long texts take time in proportion to their length.

The field's nodes are the tokens of a document that hold a digit or an at sign, with the
labels none, email, ip, card, phone and secret. Neighbouring tokens are linked as a chain;
skip links join each token to the next one that repeats it or is similar (the same
digits, or the same letters in other case). Documents are gathered into graphs of about
``GRAPH_TOKENS`` tokens for loopy message passing, which makes a label agree over a document.
Weights are trained on the base spans and seeds of at most ``TRAIN_DOCS`` documents, those with the
smallest hash of their doc_id: token weights by multinomial regression, link potentials by label
counts. Each span but those of email, whose likes all show an at sign, is seen twice: as it is and with its
kind's marks hidden (a plus sign, dots, a name before it), so that links must carry what a bare token does not show.

A run of neighbouring tokens becomes a span of its own when the field is sure of one label for all of it,
each of its tokens is alike to one of a base span of that label, it passes its kind's test of
length, and no base span overlaps it. Secrets have no base pattern in ``spans``: their seeds are the values
given to a credential's name, and key ids of a known form. A token is a secret when the field is sure
of it and it is a seed or is alike to one; they have columns of their own.

Null text counts as empty. Rows that repeat a doc_id are documents of their own. An empty
table gives an empty result. Columns other than doc_id and text are ignored.
"""

import re
from bisect import bisect_right
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetpulse.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 4000
ROUNDS = 8
DAMPING = 0.5
SURE = 0.9
MAX_GAP = 2
SECRET = len(KINDS)
LABELS = len(KINDS) + 2
# Prior counts of skip links, so that a corpus without repeats has potentials for them too, and how
# often one kind of prior link is the other.
DISAGREEING, AGREEING = 0.1, 200
# Neighbours' weights are in their tokens' inputs already, those of distant tokens are not.
SHARES = np.array([0.5, 1.0])
GRAPH_TOKENS = 100_000
WORDS = 16

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)+")
DIGIT_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"[0-9]+")
TOKEN = re.compile(r"[^\s,;=()<>\[\]{}\"']+")
MARKED = re.compile(r"[0-9@]")
WORD_BEFORE = re.compile(r"([^\W\d_]+)\W*\Z")
# Names of credentials, and the public form of a cloud provider's key ids.
NAMED = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\s\"']*[=:][\s\"']*\Z")
KEY_ID = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}\Z")
SEEN_BEFORE = 40
SECRET_LENGTH = 8


def emails(text):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def addresses(text):
    for run in DOTTED.finditer(text):
        numbers = list(NUMBER.finditer(run[0]))
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k:k + 4]
            if all(len(n[0].lstrip("0")) <= 3 and int(n[0].lstrip("0") or 0) <= 255 for n in four):
                yield run.start() + four[0].start(), run.start() + four[3].end()


def luhn(digits):
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(text):
    return "".join(c for c in text if c in "0123456789")


def cards(text):
    for run in DIGIT_RUN.finditer(text):
        if run.end() - run.start() >= 16:
            digits = digits_of(run[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text):
    for run in PHONE.finditer(text):
        if 8 <= len(digits_of(run[0])) <= 15:
            yield run.span()


FINDERS = (emails, addresses, cards, phones)


def base_spans(text):
    """(kind number, start, end), by kind and start."""
    return [(kind, a, b) for kind, finder in enumerate(FINDERS) for a, b in finder(text)]


def seeded(text, start, token):
    """Whether a token is the value of a credential's name or a key id."""
    bare = token.strip(".:!?")
    if len(bare) < SECRET_LENGTH or not any(c.isalpha() for c in bare) or "@" in bare:
        return False
    return bool(KEY_ID.match(bare) or NAMED.search(text, max(0, start - SEEN_BEFORE), start))


def shape(token, seed=False):
    """What the field sees of a token, one bit each."""
    digits = len(digits_of(token))
    bare = token.strip(".:!?")
    at, _, after = bare.partition("@")
    flags = [bool(after) and bool(at), "." in after, bare.startswith("+"), bare.count(".") == 3 and digits >= 4,
             seed, "-" in bare, bool(bare) and all(c in "0123456789.-+" for c in bare),
             digits == 0, 1 <= digits <= 3, digits == 4, 5 <= digits <= 7, 8 <= digits <= 15,
             16 <= digits <= 19, digits > 19, any(c.isalpha() for c in bare), len(bare) >= 16]
    return sum(f << i for i, f in enumerate(flags))


MARK_BITS = 0b11111
SHAPE_BITS = 16
WORD_AT = SHAPE_BITS + 2
INPUTS = WORD_AT + WORDS + 1


def word_before(text, start):
    """The bucket of the word before a token, among those in sight."""
    found = WORD_BEFORE.search(text, max(0, start - SEEN_BEFORE), start)
    return crc32(found[1].lower().encode()) % WORDS if found else 0


def graph(text):
    """(tokens as (start, end), shapes with neighbour bits, chain links, skip links, names by likeness, seeds)."""
    tokens, shapes, last, alike, seeds = [], [], {}, [], []
    skips = []
    for found in TOKEN.finditer(text) if MARKED.search(text) else ():
        token = found[0]
        if not MARKED.search(token):
            continue
        k = len(tokens)
        tokens.append(found.span())
        seeds.append(seeded(text, found.start(), token))
        shapes.append(shape(token, seeds[-1]) | 1 << WORD_AT + word_before(text, found.start()))
        digits, bare = digits_of(token), token.strip(".:!?").lower()
        key = digits if len(digits) >= 6 and not any(c.isalpha() for c in bare) else bare
        if key in last:
            skips.append((last[key], k))
        last[key] = k
        alike.append(key)
    chain = [(k, k + 1) for k in range(len(tokens) - 1) if tokens[k + 1][0] - tokens[k][1] <= MAX_GAP]
    for a, b in chain:
        shapes[a] |= 1 << SHAPE_BITS
        shapes[b] |= 1 << SHAPE_BITS + 1
    return tokens, shapes, chain, skips, alike, seeds


def labels_of(tokens, spans):
    """Each token's label from the spans that overlap it; the earlier kind wins."""
    found = [0] * len(tokens)
    starts = [t[0] for t in tokens]
    for kind, a, b in reversed(spans):
        k = max(0, bisect_right(starts, a) - 1)
        while k < len(tokens) and tokens[k][0] < b:
            if tokens[k][1] > a:
                found[k] = kind + 1
            k += 1
    return found


def told_labels(g, spans):
    """Labels by base spans, then by seeds."""
    return [SECRET + 1 if seed and not label else label for label, seed in zip(labels_of(g[0], spans), g[5])]


def unpacked(shapes):
    bits = (np.asarray(shapes, np.int64)[:, None] >> np.arange(INPUTS - 1)) & 1
    return np.concatenate([bits, np.ones((len(bits), 1), np.int64)], 1).astype(np.float64)


def fit(nodes, links):
    """Weights from {(shape, label): count} and {(link sort, label, label): count}."""
    weights = np.zeros((INPUTS, LABELS))
    if nodes:
        x = unpacked([s for s, _ in nodes])
        y = np.eye(LABELS)[[label for _, label in nodes]]
        n = np.array(list(nodes.values()), np.float64)[:, None] / sum(nodes.values())
        for _ in range(400):
            logits = x @ weights
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            weights += 4.0 * (x.T @ (n * (y - chance)) - 1e-5 * weights)
    tables = np.ones((2, LABELS, LABELS)) * 0.5
    tables[1] = (np.ones((LABELS, LABELS)) + (AGREEING - 1) * np.eye(LABELS)) * DISAGREEING
    for (sort, a, b), count in links.items():
        tables[sort, a, b] += count
        tables[sort, b, a] += count
    joint = tables / tables.sum((1, 2), keepdims=True)
    alone = joint.sum(2)
    return weights, np.log(joint / (alone[:, :, None] * alone[:, None, :])) * SHARES[:, None, None]


def beliefs(own, links, sorts, tables):
    """Label chances of each node by damped loopy sum-product; memory in proportion to nodes and links."""
    if len(links):
        a = np.concatenate([links[:, 0], links[:, 1]])
        b = np.concatenate([links[:, 1], links[:, 0]])
        half = len(links)
        by_sort = [np.flatnonzero(np.concatenate([sorts, sorts]) == sort) for sort in range(len(tables))]
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        sent = np.zeros((2 * half, LABELS))

        def gathered():
            return own + np.stack([np.bincount(b, sent[:, label], len(own)) for label in range(LABELS)], 1)

        for _ in range(ROUNDS):
            cavity = gathered()[a] - sent[back]
            cavity = np.exp(cavity - cavity.max(1, keepdims=True))
            for rows, table in zip(by_sort, tables):
                cavity[rows] = cavity[rows] @ np.exp(table)
            new = np.log(cavity / cavity.sum(1, keepdims=True))
            sent = DAMPING * sent + (1 - DAMPING) * new
        own = gathered()
    return np.exp(own - np.logaddexp.reduce(own, 1, keepdims=True))


def whole(kind, text):
    """Whether an added span is long enough to be one of its kind."""
    digits = len(digits_of(text))
    return (("@" in text, len(NUMBER.findall(text)) == 4, 16 <= digits <= 19, 7 <= digits <= 15)[kind])


def runs_of(wanted, chain):
    """Maximal runs of chained neighbours with one wanted label: (label, first, last)."""
    linked, k = {a for a, _ in chain}, 0
    while k < len(wanted):
        end = k
        while end in linked and wanted[end + 1] == wanted[k]:
            end += 1
        if wanted[k]:
            yield wanted[k], k, end
        k = end + 1


def added_spans(texts, graphs, spans, weights, tables):
    """(spans that only the field finds, secrets) of each document."""
    sizes = np.array([len(g[0]) for g in graphs])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if not offsets[-1]:
        return [([], []) for _ in graphs]
    own = unpacked(np.concatenate([np.asarray(g[1], np.int64) for g in graphs])) @ weights
    links, sorts = [], []
    for g, offset in zip(graphs, offsets):
        for sort in (0, 1):
            links += [(a + offset, b + offset) for a, b in g[2 + sort]]
            sorts += [sort] * len(g[2 + sort])
    chances = beliefs(own, np.array(links, np.int64).reshape(-1, 2), np.array(sorts, np.int64), tables)
    best = np.where(chances.max(1) >= SURE, chances.argmax(1), 0)
    added = []
    for text, g, found, offset in zip(texts, graphs, spans, offsets):
        base = labels_of(g[0], found)
        known = {(key, label) for key, label, seed in zip(g[4], base, g[5]) for label in (label, seed and SECRET + 1) if label}
        wanted = [0 if label or (key, b) not in known else b
                  for key, label, b in zip(g[4], base, best[offset:offset + len(base)].tolist())]
        extra, secrets = [], []
        for label, first, last in runs_of(wanted, g[2]):
            if label == SECRET + 1:
                secrets += g[0][first:last + 1]
            elif whole(label - 1, text[g[0][first][0]:g[0][last][1]]):
                extra.append((label - 1, g[0][first][0], g[0][last][1]))
        added.append((extra, secrets))
    return added


def in_graphs(texts):
    """Documents gathered until their tokens fill a graph: (texts, their graphs)."""
    held, graphs, tokens = [], [], 0
    for text in texts:
        held.append(text)
        graphs.append(graph(text))
        tokens += len(graphs[-1][0])
        if tokens >= GRAPH_TOKENS:
            yield held, graphs
            held, graphs, tokens = [], [], 0
    if held:
        yield held, graphs


def told(spans):
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for kind, a, b in spans)


def count_batches(batches):
    """Training counts: ('node', shape, label, 0) and ('link', sort, label, label)."""
    counts = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            g = graph(text)
            shapes, chain, skips = g[1:4]
            labels = told_labels(g, base_spans(text))
            counts.update((0, s, y, 0) for s, y in zip(shapes, labels))
            counts.update((0, s & ~MARK_BITS, y, 0) for s, y in zip(shapes, labels) if y > 1)
            for sort, links in ((0, chain), (1, skips)):
                counts.update((1, sort, labels[a], labels[b]) for a, b in links)
    columns = list(zip(*counts)) if counts else [()] * 4
    yield pa.RecordBatch.from_arrays(
        [*[pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.int32()))], pa.array(list(counts.values()), pa.int64())],
        ["sort", "a", "b", "c", "n"])


def train(docs, train_docs=TRAIN_DOCS):
    """The field's weights from base spans; counts are over shapes and labels, a bounded number."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs).select(
        F.col("doc_id").alias("__chosen"))
    texts = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__chosen"), "left_semi").select("text")
    counts = texts.mapInArrow(count_batches, "sort int, a bigint, b int, c int, n bigint").groupBy(
        "sort", "a", "b", "c").agg(F.sum("n").alias("n")).collect()
    return fit({(r.a, r.b): r.n for r in counts if r.sort == 0},
               {(r.a, r.b, r.c): r.n for r in counts if r.sort == 1})


def finder(weights, tables):
    def find(batches):
        for batch in batches:
            spans, extra = [], []
            for texts, graphs in in_graphs(batch.column("text").to_pylist()):
                base = [base_spans(t) for t in texts]
                spans += base
                extra += added_spans(texts, graphs, base, weights, tables)
            told_base = [told(s) for s in spans]
            counts = [[sum(k == kind for k, _, _ in s) for s in spans] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([sha256(b.encode()).hexdigest() for b in told_base], pa.string()),
                 pa.array([told(sorted(s + x)) for s, (x, _) in zip(spans, extra)], pa.string()),
                 pa.array([len(x) for x, _ in extra], pa.int64()),
                 pa.array([",".join(f"secret:{a}:{b}" for a, b in y) for _, y in extra], pa.string()),
                 pa.array([len(y) for _, y in extra], pa.int64()),
                 pa.array([len(s) + len(x) + len(y) for s, (x, y) in zip(spans, extra)], pa.int64())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "secret_spans", "n_secret",
                 "n_found"])
    return find


def personal_data(docs):
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added, secret_spans, n_secret,
    n_found (spans and secrets together)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return texts.mapInArrow(
        finder(*train(texts)), f"doc_id bigint, {counts}, base_sha256 string, spans string, n_added bigint, "
        "secret_spans string, n_secret bigint, n_found bigint")
