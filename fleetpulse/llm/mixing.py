"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source's rate is the mean number of times each of its documents must occur for the
source to reach its share of the mixture's characters. A document's count is the Poisson
distribution of that mean, inverted at a number hashed from seed and doc_id; so it is
the same in every run and on every executor. Documents are exploded by their count
and dealt out anew by a hash of (doc_id, copy), which is also their order.

Large means are split into parts of at most ``PART_MEAN`` with a hash each; the sum has
the wanted distribution, and no rate is cut.

Sizes are characters plus one, so that a source of empty texts has a size. Null text counts
as empty; null source is a source of its own, as is the empty name. Rows that repeat a doc_id
get equal counts. A source missing from given weights weighs 0. An empty table gives an
empty result. Other columns are carried along; those with the names of the two new columns
are replaced.
"""

from pyspark.sql import functions as F

from fleetpulse.llm.common import shuffle_width, text_or_empty, written

SEED = 2024
PART_MEAN = 8.0
CDF_STEPS = 64
BROADCAST_SOURCES = 100_000

# P(X <= k) for k = 0, 1, ... of a Poisson variable of mean ``part_mean``
CDF = f"""aggregate(sequence(1, {CDF_STEPS}),
    named_struct('term', exp(-part_mean), 'cdf', array(exp(-part_mean))),
    (a, k) -> named_struct('term', a.term * part_mean / k,
                           'cdf', array_append(a.cdf, element_at(a.cdf, -1) + a.term * part_mean / k)),
    a -> a.cdf)"""


def hashed(label, *columns):
    """52 (or with label 'order' 60) hashed bits of the columns, as a long."""
    digits = 15 if label == "order" else 13
    key = F.concat_ws(":", F.lit(f"{label}{SEED}"), *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.md5(key), 1, digits), 16, 10).cast("long")


def rates(docs, weights=None, epochs=1.0):
    """source, parts, cdf: how often to repeat each source's documents.

    ``weights`` maps source names to weights; without it all sources weigh the same.
    The mixture has ``epochs`` times the characters of the table.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.char_length(text_or_empty()) + 1).alias("size"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.coalesce(F.element_at(F.create_map(
            *[F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]),
            F.coalesce("source", F.lit(""))), F.lit(0.0))
    weighed = written(sizes.withColumn("weight", weight), "source-sizes")
    totals = weighed.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight")).first()
    share = F.col("weight") / F.lit(float(totals.all_weight or 1))
    rate = share * F.lit(float(totals.all_size or 0) * epochs) / F.col("size")
    return weighed.select("source", rate.alias("rate")).select(
        F.col("source").alias("__source"),
        F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int").alias("__parts"),
        (F.col("rate") / F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1))).alias("part_mean"),
    ).select("__source", "__parts", F.expr(CDF).alias("__cdf"))


def mixed(docs, weights=None, epochs=1.0, names=("copy", "shuffle_key")):
    """Documents repeated to the target weights, in a new global order, with two more columns."""
    copy_name, key_name = names
    found = written(rates(docs.select("source", "text"), weights, epochs), "source-rates")
    if found.count() <= BROADCAST_SOURCES:
        rated = docs.join(F.broadcast(found), F.col("source").eqNullSafe(F.col("__source")))
    else:
        salts = shuffle_width(docs.sparkSession)
        spread = found.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = docs.withColumn("__own", F.pmod(F.hash("doc_id"), F.lit(salts)))
        rated = salted.join(spread, F.col("source").eqNullSafe(F.col("__source"))
                            & (F.col("__own") == F.col("__salt"))).drop("__own", "__salt")
    uniform = lambda part: hashed("count", F.col("doc_id"), part) / F.lit(float(1 << 52))
    count = F.aggregate(F.sequence(F.lit(1), F.col("__parts")), F.lit(0), lambda total, part: total + F.size(
        F.filter("__cdf", lambda c: c <= uniform(part))))
    counted = rated.withColumn("__count", count).filter("__count > 0").drop("__cdf", "__parts", "__source")
    copies = counted.withColumn(copy_name, F.explode(F.expr("sequence(0, __count - 1)"))).drop("__count")
    keyed = copies.withColumn(key_name, hashed("order", F.col("doc_id"), F.col(copy_name)))
    return keyed.repartition(key_name).sortWithinPartitions(key_name)


def replicated(docs, weights=None, epochs=1.0):
    """As ``mixed``, with the columns of ``docs`` only."""
    return mixed(docs, weights, epochs, ("__copy", "__order")).select(*docs.columns)


ORACLE = f"""
WITH sizes AS (SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source),
rates AS (SELECT source, (1.0 / count(*) OVER ())::DOUBLE * (sum(size) OVER ())::DOUBLE / size AS rate FROM sizes),
split AS (SELECT source, greatest(ceil(rate / {PART_MEAN}), 1)::INT AS parts,
                 rate / greatest(ceil(rate / {PART_MEAN}), 1) AS part_mean FROM rates),
cdf AS (SELECT source, parts, k, sum(exp(-part_mean) * part_mean ** k / gamma(k + 1.0))
               OVER (PARTITION BY source ORDER BY k) AS c
        FROM split, range(0, {CDF_STEPS} + 1) AS steps(k)),
draws AS (SELECT d.doc_id, d.source, p.part,
                 ('0x' || substr(md5('count{SEED}:' || d.doc_id || ':' || p.part), 1, 13))::BIGINT
                 / {float(1 << 52)} AS u
          FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source,
               LATERAL (SELECT unnest(range(1, s.parts + 1)) AS part) p),
counts AS (SELECT doc_id, count(*) AS n
           FROM draws JOIN cdf ON draws.source IS NOT DISTINCT FROM cdf.source AND cdf.c <= draws.u
           GROUP BY doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, copies.copy::INT AS copy,
       ('0x' || substr(md5('order{SEED}:' || d.doc_id || ':' || copies.copy), 1, 15))::BIGINT AS shuffle_key
FROM documents d JOIN counts USING (doc_id), LATERAL (SELECT unnest(range(0, n)) AS copy) copies
"""
