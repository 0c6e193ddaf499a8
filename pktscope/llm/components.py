"""Connected components of a link table by repeated contraction.

Every round each node points at its smallest neighbour, pointers are jumped
once, and the links are rewritten between what the nodes point at; nodes that
nothing points at leave the table.  Each round's tables are landed on shared
storage.  All steps are joins and map-side combined minima, so a node with very
many links is no hot task, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land, scratch, temporary


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of
    the component.  Null ends and self links are ignored; an empty table gives
    an empty one.  The tables of the rounds are removed, the result is a landed
    one."""
    spark = links.sparkSession
    path = scratch(spark, "components")
    with temporary(spark):
        return land(_contract(links, a, b), "components", path)


def _contract(links: DataFrame, a: str, b: str) -> DataFrame:
    both = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = land(both.distinct(), "cc-links")
    where = None
    while not edges.isEmpty():
        out = edges.union(edges.select("b", "a"))
        near = land(out.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("p")), "cc-near")
        hop = near.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        parent = land(near.join(hop, "p").select("node", F.col("pp").alias("root")), "cc-parent")
        if where is None:
            where = parent
        else:
            step = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            where = land(where.join(step, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "cc-where")
        pa = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        pb = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = land(edges.join(pa, "a").join(pb, "b").filter("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-links")
    if where is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return where
