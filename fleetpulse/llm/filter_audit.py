"""What each filter removes under every order of the filters, by difference arrays over Lehmer ranks.

Orders of n filters are numbered lexicographically, from 0 to n! - 1. All orders that begin with
the same k filters are then one interval of (n - k)! ranks, which the Lehmer code of the
beginning locates. A document is described by the mask of the filters it fails; it is removed at
step k by the orders whose first k - 1 filters it passes and whose k-th it fails: a few intervals for each
mask and step. Documents are counted by part and mask, the counts are added where an interval
starts and taken off where it ends, and a prefix sum over the ranks gives what each order removes
at each step. No document is ever paired with an order.

Null text counts as empty, null part as the empty name. A filter for copies marks every row whose
text also occurs under a smaller id in the whole table; rows that share the smallest id all
stay, and a null id comes after all others. Texts are told apart by their SHA-256. Rows that repeat a
doc_id count as rows of their own; a document is good or toxic if any label of its id says so.
Columns besides doc_id, text and the part are ignored. An empty table gives an empty result.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import text_or_empty

NO_ID_SPREAD = 1024
WHITE_SPACE = r"[\x20\x09-\x0D]+"
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_filters(text):
    """Letter of each filter and the condition under which ``text`` fails it."""
    words = F.array_remove(F.split(text, WHITE_SPACE), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": capitals * 100 > F.length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def first_rank(beginning, n):
    """The lexicographic rank of the first order of 0..n-1 that starts with ``beginning``."""
    rank, left = 0, list(range(n))
    for k, item in enumerate(beginning):
        rank += left.index(item) * math.factorial(n - 1 - k)
        left.remove(item)
    return rank


def removal_intervals(mask, n):
    """(step, first rank, past last rank) of the orders that remove ``mask`` at each step."""
    failed = [i for i in range(n) if mask >> i & 1]
    passed = [i for i in range(n) if not mask >> i & 1]
    found = []
    for step in range(len(passed) + 1 if failed else 0):
        width = math.factorial(n - 1 - step)
        for before in itertools.permutations(passed, step):
            starts = (first_rank((*before, last), n) for last in failed)
            found += [(step, start, start + width) for start in starts]
    return found


def auditor(names):
    """Of a part's counts by mask (at most 2^n rows): a row for each order and step."""
    n, orders = len(names), math.factorial(len(names))
    filter_at = np.array(list(itertools.permutations(range(n)))).T  # by step and rank

    def audited(counts):
        masks = np.array(counts.column("mask").to_pylist(), np.int64)
        weights = np.array([counts.column(c).to_pylist() for c in ("n", "good", "toxic")], np.int64).T
        changes = np.zeros((n, orders + 1, 3), np.int64)
        for mask, weight in zip(masks.tolist(), weights):
            for step, start, end in removal_intervals(mask, n):
                changes[step, start] += weight
                changes[step, end] -= weight
        removed = changes.cumsum(axis=1)[:, :orders]
        gone = removed[:, :, 0]
        failing = np.array([weights[masks >> i & 1 == 1, 0].sum() for i in range(n)])
        only = np.array([weights[masks == 1 << i, 0].sum() for i in range(n)])
        over_all = np.array([gone[filter_at == i].sum() for i in range(n)])
        columns = {
            "kept": weights[:, 0].sum() - gone.cumsum(axis=0), "removed": gone,
            "redundant": failing[filter_at] - gone, "unique_fails": only[filter_at],
            "good_lost": removed[:, :, 1], "toxic_lost": removed[:, :, 2], "shapley": over_all[filter_at],
        }
        labels = ["".join(names[i] for i in order) for order in filter_at.T]
        return pa.table({
            "part": pa.array([counts.column("part")[0].as_py()] * n * orders, pa.string()),
            "filter_order": pa.array(np.tile(labels, n).tolist(), pa.string()),
            "step": pa.array(np.repeat(np.arange(1, n + 1), orders), pa.int32()),
            **{name: pa.array(values.ravel(), pa.int64()) for name, values in columns.items()}})
    return audited


def with_labels(rows, labels):
    """``rows`` (doc_id, ...) with flags good and toxic; rows without an id are spread over tasks."""
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("spread", F.lit(0).cast("long"))
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id() % NO_ID_SPREAD + 1).otherwise(0)
    return rows.withColumn("spread", spread).join(marks, ["doc_id", "spread"], "left").withColumns(
        {flag: F.coalesce(flag, F.lit(False)) for flag in ("good", "toxic")})


def counts_by_mask(docs, labels, filters, part):
    """part, mask, n, good, toxic: rows by the set of filters they fail, copies as the last bit."""
    text = F.col("text")
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(filters(text).values())), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    rows = rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("text_key"))
    kind = ("text_key", "part", "mask", "good", "toxic")
    by_id = with_labels(rows, labels).groupBy("doc_id", "spread", *kind).agg(F.count("*").alias("n"))
    # of each kind of copies: their number, and of those how many rows have the smallest id
    folded = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    first = F.min("least").over(Window.partitionBy("text_key"))
    stay = F.when(first.isNull(), F.col("no_id")).when(F.col("least") == first, F.col("at_least")).otherwise(0)
    copies = 1 << len(filters(text))
    split = folded.withColumn("stay", stay).select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("stay").alias("n")),
        F.struct((F.col("mask") + copies).alias("mask"), (F.col("n") - F.col("stay")).alias("n")))).alias("c"))
    weight = F.col("c.n")
    return split.filter("c.n > 0").groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum(weight).alias("n"), F.sum(F.when(F.col("good"), weight).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), weight).otherwise(0)).alias("toxic"))


def filter_audit(docs, labels, filters=text_filters, copies="E", part="lang"):
    """A row per part, order of the filters and step, with what the step's filter does there.

    ``filters`` maps the text column to a dict of letter and failure condition; ``copies`` is the letter
    of the filter for copies. The table of orders grows with the factorial of their number.
    """
    names = [*filters(F.col("text")), copies]
    counts = counts_by_mask(docs, labels, filters, part)
    return counts.groupBy("part").applyInArrow(auditor(names), SCHEMA)


ORACLE = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
failed AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM texts),
counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM failed LEFT JOIN labels USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, k::INT AS step, substr(filter_order, k, 1) AS letter, substr(filter_order, 1, k - 1) AS earlier
  FROM orders, range(1, 6) AS r(k)),
found AS (
  SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS hit, fails = letter AS alone,
         EXISTS (SELECT 1 FROM letters WHERE contains(fails, l) AND contains(earlier, l)) AS gone
  FROM counted, steps),
summed AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT gone AND hit), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (gone AND hit), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND hit), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND hit), 0)::BIGINT AS toxic_lost
  FROM found GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed"""
