"""Main text of web pages by a tree-structured graphical model.

Nodes are the block elements of a page's tree, each content or not. A node's own potential
is a weighted sum of what its tag, class names and text look like; a parent and
its child share a potential table. Sum-product messages go up from the leaves and down
from the root once, which gives exact marginals; a node's text is kept when its marginal is
above one half. Elements that can't hold article text (scripts, forms, menus, ...) and all
below them are fixed as no content.

Weights start from a prior and are trained by the likelihood of labelled pages: pages that
mark their article themselves, at most ``TRAIN_PAGES`` different ones with the smallest hash, none of more
than ``TRAIN_CHARS`` characters. Pages without marks are judged by the same model. A page that ends
inside a tag ends before that.

Null and empty html give an empty text. Rows that repeat a page_id are pages of their own. An
empty table gives an empty result. Other columns are ignored.
"""

import html
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

TRAIN_PAGES = 400
TRAIN_CHARS = 1 << 20
STEPS = 40

# Names of HTML elements, and words in class names.
NEVER = frozenset("""head script style noscript template nav header footer aside form iframe object svg
    button select textarea input label menu dialog canvas audio video math title""".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp
    small span strike strong sub sup time tt u var wbr""".split())
KNOWN = ("html body div section article main p h1 h2 h3 h4 h5 h6 ul ol li table tbody tr td th blockquote "
         "pre figure figcaption dl dt dd hr details summary address center").split()
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6
    header hr main menu nav ol p pre section table ul""".split())
WALLS = frozenset("table ul ol dl article section main div body html".split())
AGAINST = re.compile(r"""(ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|alert|popup|modal|
    sidebar|menu|nav\w*|breadcrumbs?|foot(er)?|head(er)?|masthead|comments?|respon(d|ses)|discuss\w*|replies|reply|
    share|sharing|social|related|recommend\w*|newsletter|subscri\w*|signup|login|widget|toolbar|pagination|
    pager|copyright|disclaimer|legal|teaser|outbrain|taboola|hidden|skip)""", re.I | re.X)
FOR = re.compile(r"\b(article|content|post|story|entry|main|body|text)\b", re.I)
# Of a name of several words: what it says about the block's surroundings or state, not about the block.
BESIDE = frozenset("has have with no non without overflow hide".split())
STATE = frozenset("layout fixed sticky open opened closed collapsed expanded enabled disabled template".split())
HOLDER = frozenset("wrap wrapper container outer inner".split())
PLURAL = frozenset("list area section block box".split())
STRONG = re.compile(r"(article|post|entry|story|main|page)[-_]*(content|body|text)|main|article", re.I)

# Words that name no content of their own: beside a boilerplate word they leave a name boilerplate.
FURNITURE = frozenset("""posts articles stories links link buttons button bar bars icons items item list lists section block
    box area slot unit form wrap wrapper container outer inner title heading count top bottom left right inline post
    article story page site main content entry text body media news""".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
# A quote opens a value only after the equals sign. All repeats are possessive, so a tag is read once.
ATTRIBUTES = re.compile(
    r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+)*+>""")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+)))?+""")
NAMING = frozenset(["class", "id", "role"])

TAG = {name: i for i, name in enumerate([*KNOWN, "other"])}
CUES = ("against", "for", "under_against", "under_article", "under_for", "no_text", "short", "middle", "long",
        "linked", "sentences", "bias")
CUE = {name: len(TAG) + i for i, name in enumerate(CUES)}
FEATURES = len(TAG) + len(CUES)


def prior():
    """Weights before training, and the log potentials of (parent, child) labels."""
    weights = np.zeros(FEATURES)
    for name, value in {"article": 4, "main": 3, "p": 1, "blockquote": 1, "pre": 1, "body": -1, "html": -3,
                        "li": -0.5, "td": -0.2, "address": -1}.items():
        weights[TAG[name]] = value
    for name, value in {"against": -6, "for": 1.5, "under_against": -6, "under_article": 3, "under_for": 1.5, "short": -0.3,
                        "middle": 0.5, "long": 1.5, "linked": -2.5, "sentences": 0.7, "bias": -0.3}.items():
        weights[CUE[name]] = value
    return weights, np.array([[0.8, -0.4], [-0.6, 1.2]])


class Node:
    __slots__ = ("tag", "parent", "barred", "against", "article", "strong", "text", "linked", "features")

    def __init__(self, tag, parent, barred, against, article, strong, features):
        self.tag, self.parent, self.barred = tag, parent, barred
        self.against, self.article, self.strong, self.features = against, article, strong, features
        self.text = self.linked = 0


def boilerplate(name, in_article=False):
    """Whether a class, id or role names its own block as no content: by its first or its head word.

    Inside an article all other words must be furniture: "related-posts" is no content, "related-work" is.
    """
    words = re.split("[-_]+", re.sub("(side|sign)[-_](?=bar|up)", r"\1", name.lower()).strip("-_"))
    if len(words) > 1 and (words[0] in BESIDE or words[-1] in STATE):
        return False
    around = False
    while len(words) > 1 and words[-1] in HOLDER | PLURAL:
        around |= words.pop() in HOLDER
    if around and any(FOR.fullmatch(w) for w in words):
        return False
    if in_article and not all(AGAINST.fullmatch(w) or w in FURNITURE for w in words):
        return False
    return bool(AGAINST.fullmatch(words[0]) or AGAINST.fullmatch(words[-1]))


def attributes(text):
    """(values of class, id and role, whether a slash closes the tag) of what follows a tag's name."""
    names, last = [], 0
    for found in ATTRIBUTE.finditer(text):
        last = found.end()
        if found[1].lower() in NAMING:
            names += (found[2] or found[3] or found[4] or "").split()
    return names, "/" in text[last:]


def parse(page):
    """(nodes in page order, pieces of text as (node number, text)); None marks a block's bound.

    Time grows with the page's length, whatever it holds: open elements are found by their tag.
    """
    nodes = [Node("html", -1, False, False, False, False, [TAG["html"], CUE["bias"]])]
    stack, places = [("html", 0)], defaultdict(list)
    pieces, links, at, end = [], 0, 0, len(page)

    def nearest(tags):
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def push(tag, node):
        places[tag].append(len(stack))
        stack.append((tag, node))

    def close(tags, walls=WALLS):
        """Close the nearest open element among ``tags``, unless a wall stands before it."""
        nonlocal links
        k = nearest(tags)
        if not k or k < nearest(walls):
            return
        block = False
        for t, _ in stack[k:]:
            places[t].pop()
            links -= t == "a"
            block |= t not in INLINE
        if block:
            pieces.append(None)
        del stack[k:]

    def say(raw):
        node = stack[-1][1]
        if not nodes[node].barred:
            text = html.unescape(raw)
            pieces.append((node, text))
            size = len(text.strip())
            nodes[node].text += size
            if links > 0:
                nodes[node].linked += size

    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at:found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        rest = ATTRIBUTES.match(page, at)
        if not rest:  # the page ends inside a tag
            break
        given, at = page[at:rest.end() - 1], rest.end()
        if found[1]:
            if tag == "br":
                pieces.append(None)
            else:
                close({tag}, ())
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
            pieces.append(None)
            continue
        if tag in VOID:
            if tag not in ("wbr", "img"):
                pieces.append(None)
            continue
        if tag in INLINE:
            links += tag == "a"
            push(tag, stack[-1][1])
            continue
        if tag in ("html",):
            continue
        if tag in ENDS_P:
            close({"p"})
        if tag in CLOSES:
            close(CLOSES[tag], WALLS - {"table"} if tag in ("tr", "td", "th") else WALLS)
        pieces.append(None)
        up = stack[-1][1]
        names, closed = attributes(given)
        above = nodes[up]
        features = [TAG.get(tag, TAG["other"]), CUE["bias"]]
        marked = any(boilerplate(name, above.article) for name in names)
        strong = any(map(STRONG.fullmatch, names))
        root = tag in ("article", "main")
        # an article in a marked block is free of the mark, unless it is marked itself or part of an article
        inherited = above.against and (marked or above.article or not (root or strong))
        against = marked and tag != "body" and (above.against or not root)
        if against:
            features.append(CUE["against"])
        elif names and FOR.search(" ".join(names).replace("_", " ")):
            features.append(CUE["for"])
        if inherited:
            features.append(CUE["under_against"])
        if above.article:
            features.append(CUE["under_article"])
        elif above.strong and not (inherited or against):
            features.append(CUE["under_for"])
        nodes.append(Node(tag, up, above.barred or tag in NEVER, inherited or against,
                          above.article or root, (above.strong or strong) and not against, features))
        if not closed:
            push(tag, len(nodes) - 1)
    for node in nodes:
        size = node.text
        node.features.append(CUE["no_text" if not size else "short" if size < 40 else "middle" if size < 160 else "long"])
        if size and node.linked > 0.5 * size:
            node.features.append(CUE["linked"])
    for piece in pieces:
        if piece and re.search(r"[.!?](\s|$)", piece[1]) and CUE["sentences"] not in nodes[piece[0]].features:
            nodes[piece[0]].features.append(CUE["sentences"])
    return nodes, pieces


def log_sum(a, b):
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(parents, own, barred, table):
    """(P(node is content), expected label pairs over edges) by messages up and down the tree.

    Nodes come parents first. ``own`` is the log odds of each node; a barred node is 0.
    """
    n = len(parents)
    (t00, t01), (t10, t11) = table.tolist()
    low, high = [0.0] * n, [-math.inf if b else float(o) for o, b in zip(own, barred)]
    up = [(0.0, 0.0)] * n
    for k in range(n - 1, 0, -1):
        a, b = low[k], high[k]
        up[k] = ((log_sum(t00 + a, t01 + b), log_sum(t10 + a, t11 + b)) if b > -math.inf else (t00 + a, t10 + a))
        low[parents[k]] += up[k][0]
        high[parents[k]] += up[k][1]
    pairs = np.zeros((2, 2))
    for k in range(1, n):
        p = parents[k]
        a, b = low[p] - up[k][0], high[p] - up[k][1]
        joint = (a + t00 + low[k], a + t01 + high[k], b + t10 + low[k], b + t11 + high[k])
        top = max(joint)
        weights = [math.exp(x - top) for x in joint]
        total = sum(weights)
        pairs += np.array(weights).reshape(2, 2) / total
        down = ((t00 + a, t10 + b), (t01 + a, t11 + b))
        low[k] += log_sum(*down[0]) if down[0][1] > -math.inf else down[0][0]
        high[k] += log_sum(*down[1]) if down[1][1] > -math.inf else down[1][0]
        shift = max(low[k], high[k])
        low[k], high[k] = low[k] - shift, high[k] - shift
    chances = [0.0 if h == -math.inf else 1 / (1 + math.exp(min(500.0, lo - h))) for lo, h in zip(low, high)]
    return chances, pairs


def main_text(page, weights, table):
    nodes, pieces = parse(page or "")
    own = [float(weights[n.features].sum()) for n in nodes]
    chances, _ = marginals([n.parent for n in nodes], own, [n.barred for n in nodes], table)
    kept = [" " if p is None else p[1] for p in pieces if p is None or chances[p[0]] > 0.5]
    return " ".join("".join(kept).split())


def labelled_rows(batches):
    """Of pages that mark their article: parents, features, barred nodes and labels."""
    for batch in batches:
        rows = []
        for key, page in zip(batch.column("key").to_pylist(), batch.column("html").to_pylist()):
            nodes, _ = parse(page)
            if any(n.article for n in nodes):
                rows.append({"key": key, "parents": [n.parent for n in nodes], "features": [n.features for n in nodes],
                             "barred": [n.barred for n in nodes],
                             "labels": [int(n.article and not n.barred and not n.against) for n in nodes]})
        kinds = {"key": pa.int64(), "parents": pa.list_(pa.int32()), "features": pa.list_(pa.list_(pa.int32())),
                 "barred": pa.list_(pa.bool_()), "labels": pa.list_(pa.int32())}
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()],
                                         list(kinds))


def train(pages, train_pages=TRAIN_PAGES):
    """Weights and edge table by gradient steps on the labelled pages' likelihood.

    Pages are chosen by their keys alone; equal pages train once, in an order that the files do not change.
    """
    keyed = pages.filter(F.length("html") <= TRAIN_CHARS).select("html", F.xxhash64("page_id", "url", "html").alias("key"))
    chosen = keyed.select("key").distinct().orderBy("key").limit(train_pages)
    rows = keyed.join(F.broadcast(chosen), "key").mapInArrow(
        labelled_rows, "key long, parents array<int>, features array<array<int>>, barred array<boolean>, labels array<int>"
    ).dropDuplicates(["key"]).toArrow().sort_by("key").to_pylist()
    weights, table = prior()
    start, first = weights.copy(), table.copy()
    for _ in range(STEPS if rows else 0):
        slope, edges, count = np.zeros_like(weights), np.zeros((2, 2)), 0
        for r in rows:
            own = [weights[f].sum() for f in r["features"]]
            chances, pairs = marginals(r["parents"], own, r["barred"], table)
            for f, label, chance, barred in zip(r["features"], r["labels"], chances, r["barred"]):
                if not barred:
                    slope[f] += label - chance
            labels = np.array(r["labels"])
            np.add.at(edges, (labels[r["parents"][1:]], labels[1:]), 1)
            edges -= pairs
            count += len(labels)
        weights += 2.0 * (slope / count - 1e-3 * (weights - start))
        table += 1.0 * (edges / count - 1e-3 * (table - first))
    return weights, table


def extractor(weights, table):
    def extract(batches):
        for batch in batches:
            texts = [main_text(page, weights, table) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return extract


def main_texts(pages):
    """page_id, url, text, n_chars of each page."""
    needed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return needed.mapInArrow(extractor(*train(needed)), "page_id bigint, url string, text string, n_chars bigint")
