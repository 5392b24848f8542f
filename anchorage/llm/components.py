"""Connected components by alternating stars; each round is a stored table."""

from pyspark.sql import functions as F

from anchorage.sources import sinks


def smallest(edges):
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it is connected to.

    Each round links the larger neighbours of every node, then the others, to the smallest
    one; a minimum is combined before the shuffle, so a centre of many links is no hot
    spot. Ends when the links stop changing. Null ends are not links.
    """
    links = (
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )
    links, before = sinks.materialize(links), None
    while True:
        links = sinks.materialize(_small_star(sinks.materialize(_large_star(links))))
        now = links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.xxhash64("lo", "hi"))
        ).first()
        if now == before:
            break
        before = now
    pairs = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return pairs.union(links.select("lo", "lo")).groupBy("node").agg(F.min("root").alias("root"))


def _large_star(links):
    both = links.union(links.select("lo", "hi")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return _as_links(both.where("v > u").join(least, "u"))


def _small_star(links):
    down = links.toDF("u", "v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
    return _as_links(down.join(least, "u")).union(own).where("hi != lo").distinct()


def _as_links(df):
    return df.where("v != m").select(F.greatest("v", "m").alias("hi"), F.least("v", "m").alias("lo")).distinct()
