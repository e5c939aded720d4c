"""Connected components of a table of links, by alternating large and small stars.

Every round is a few equi-joins and minima with map-side combining, written to the shared folder; the driver sees a count and
a checksum. The number of rounds grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of a link (columns a, b) but the smallest of its component, with that smallest one.

    Loops and links with a null end are left out; repeated links count once. No links: an empty table.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if state == seen or not state.n:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        edges = stored(_small(_large(edges)).distinct(), "links")


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour (or itself)."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    pairs = edges.join(least, "u")
    return pairs.select("u", F.col("m").alias("v")).union(pairs.where("v <> m").select("v", "m"))
