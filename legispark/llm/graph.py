"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legispark.llm.storage import removed, written

#: Alternations after which something is wrong: the paths' lengths halve or better each time.
MOST_ROUNDS = 64


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (large) or smaller neighbours, and itself, to the least of them."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:  # a table of its own, so that the join below has two shuffles and a node with many links is split at run time
        least = written(least, "least")
    joined = both.join(least, "u")
    if large:
        out = written(joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "stars")
        removed(least)
        return out
    out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """links: a, b (long). Returns node, component: the least node that it reaches, for every node but those.

    Large and small stars alternate (Kiveris and others, 2014) until nothing changes; each step is a written table, and
    those before it are removed. A node's links are counted down before they are shuffled, and joined, not gathered.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    for _ in range(MOST_ROUNDS):
        n, digest = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if not n or (n, digest) == before:
            break
        before = (n, digest)
        half = _stars(edges, True)
        new = written(_stars(half, False), name)
        removed(half)
        removed(edges)
        edges = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
