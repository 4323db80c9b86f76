"""Connected components by repeated contraction; no group is ever gathered in one task and nothing on the driver.

Each round gives every node the neighbour (or itself) with the smallest hash, then renames both ends of every edge so;
edges whose ends meet are gone. A constant share of the nodes goes each round. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadpulse.llm.common import landed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of ``edges`` (a, b): nodes with equal roots are connected. Roots are nodes."""
    pair = F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = landed(edges.where("a <> b").select(pair.alias("e")).distinct().select("e.a", "e.b"), "edges")
    both = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    names = both.select("node", F.col("node").alias("root"))
    while not edges.isEmpty():
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to")))
        to = F.when(F.col("least.h") < F.xxhash64("a"), F.col("least.to")).otherwise(F.col("a"))
        moves = landed(ends.groupBy("a").agg(least.alias("least")).select(F.col("a").alias("was"), to.alias("to")), "moves")
        names = landed(
            names.join(moves, names["root"] == moves["was"], "left").select("node", F.coalesce("to", "root").alias("root")),
            "names",
        )
        first, second = moves.toDF("a", "x"), moves.toDF("b", "y")
        moved = edges.join(first, "a").join(second, "b").where("x <> y")
        edges = landed(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return names
