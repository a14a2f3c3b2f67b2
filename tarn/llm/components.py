"""Connected components of a link table, entirely as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarn.llm.common import saved


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Alternates two star rounds: each node hands its larger neighbours to its
    smallest one, then all its smaller neighbours.  The number of rounds grows
    with the logarithm of the component size.  A node with very many links is
    an ordinary skewed join key, which adaptive execution splits because both
    sides of each join are stored; minima combine on the map side.  No links
    give an empty table.
    """
    x, y = F.col(a), F.col(b)
    edges = saved(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "links")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = saved(large, "large-star")
        least = saved(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        edges = saved(small, "small-star")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    own = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(own)
