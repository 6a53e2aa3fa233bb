"""Connected components of a distributed edge table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import discard, saved


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is
    the smallest node reachable.  Alternates large-star and small-star steps
    (every node's neighbours are hung on their least neighbour) until no edge
    changes; each step is one grouped minimum and one join, and is saved.

    Nulls and loops are dropped, repeated links count once, no links give an
    empty table.
    """
    clean = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = saved(
        clean.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), f"{name}-links"
    )
    before = None
    while True:
        both = edges.select("v", "u").union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("v <> u").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.v", "e.u")
        old, edges = edges, saved(small.where("v <> u").distinct(), f"{name}-step")
        discard(old)
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
        if before == state:
            break
        before = state
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    )
