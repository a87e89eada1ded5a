"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One half-step of the two-phase star algorithm: neighbours of a node are handed to the least one near it.

    ``large``: the greater neighbours of each node; else the node itself and its lesser ones.
    """
    links = links.where("a <> b")
    if large:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        around = around.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = around.join(least.hint("merge"), around["u"] == least["w"])
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select(F.col("w").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b")


def components(ws: Workspace, links: DataFrame) -> DataFrame:
    """(node, root): every node of a link and the least node it is connected with.

    Each round hangs neighbours below the least node near them, until nothing moves; the number of rounds grows with the
    logarithm of the size. A node with very many links is a skewed join key, which adaptive execution splits.
    """
    now = ws.write(links.select("a", "b").where("a <> b").distinct())
    while True:
        wide = ws.write(_stars(now, large=True))
        after = ws.write(_stars(wide, large=False).distinct())
        ws.drop(now, wide)
        now = after
        # Done once every node hangs below one other that hangs below none; ``b`` is below ``a`` in every link.
        lower = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        ends = lower.union(lower.select(F.col("root").alias("node"), F.lit(None).cast("long").alias("root")))
        nodes = ends.groupBy("node").agg(
            F.count("root").alias("above"), F.count_if(F.col("root").isNull()).alias("below"), F.min("root").alias("root")
        )
        nodes = ws.write(nodes)
        if nodes.where("above > 1 or (above = 1 and below > 0)").isEmpty():
            ws.drop(now)
            return nodes.select("node", F.coalesce("root", "node").alias("root"))
        ws.drop(nodes)
