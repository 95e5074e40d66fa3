"""Connected components of a table of links, by passing links to smaller neighbours."""

from pyspark.sql import functions as F

from fleetpulse.llm.common import written


def components(links, left="a", right="b"):
    """node, component: each linked node with the smallest node it reaches.

    Each round points a node's larger neighbours to its smallest neighbour, then its
    smaller ones, until every link points to its component's smallest node. A round
    folds before it shuffles and no node's neighbours are ever gathered; chains shrink
    by a constant factor a round.
    """
    edges = written(links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = written(larger.distinct(), "large-star")
        small = held.groupBy("u").agg(F.min("v").alias("m"))
        smaller = held.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(smaller.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
