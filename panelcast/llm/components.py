"""Connected components of a distributed graph by contraction.

Each round every node hooks to its smallest neighbour if that is smaller than itself, pointer
jumping turns the hooks into stars, and the edges are rewritten between the stars' centres until
none is left.  Minima are combined before each shuffle, and joins meet a node's many rows with
the one row of its parent, which adaptive execution may split, so a node with very many
neighbours is no obstacle.  Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.sources.sinks import materialize


def _jump(parents: DataFrame) -> DataFrame:
    """Stars: every ``node`` with the end of its chain of ``parent`` pointers."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jumped = parents.join(up, "parent", "left").select(
            "node", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved")
        )
        jumped = materialize(jumped, "jump")
        parents = jumped.select("node", "parent")
        if jumped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) of all nodes of ``edges`` (``a``, ``b``) but the roots.

    Loops and repeated edges may occur; an empty graph gives an empty table.
    """
    edges = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"), "edges")
    total = None
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        hooks = ends.select("e.a", "e.b").groupBy("a").agg(F.min("b").alias("parent")).where("parent < a")
        stars = _jump(materialize(hooks.withColumnRenamed("a", "node"), "hooks"))
        left = stars.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = stars.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        moved = edges.join(left, "a", "left").join(right, "b", "left")
        moved = moved.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")
        edges = materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if total is None:
            total = stars
        else:
            # centres of earlier rounds may have hooked on in this one
            next_up = stars.select(F.col("node").alias("root"), F.col("parent").alias("upper"))
            total = total.withColumnsRenamed({"parent": "root"}).join(next_up, "root", "left").select(
                "node", F.coalesce("upper", "root").alias("parent")
            )
            total = materialize(total.unionByName(stars), "roots")
    if total is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return total.withColumnRenamed("parent", "root")
