"""Connected components of a link table, with DataFrame operations only.

Alternating large-star and small-star rounds (Kiveris et al., 2014) turn any graph
into stars around each component's smallest node. A round is two joins on node ids;
each is stored by a reliable checkpoint, so plans stay short and lost executors
cost one round. No component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lineage import cut


def _least(df: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of it and its neighbours ``v``, joined back to its rows."""
    least = df.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return df.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node link to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    out = _least(both).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return out.where("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    rows = _least(down)
    out = rows.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
        rows.select(F.col("m").alias("a"), F.col("u").alias("b"))
    )
    return out.where("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node with a link; ``component`` is its smallest node.

    Links with a null end or of a node to itself count for nothing.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    edges, before = cut(edges), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before, edges = state, cut(small_star(large_star(edges)))
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.union(edges.select("a", "a").distinct())
