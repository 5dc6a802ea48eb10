"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregates and two joins; nothing is collected, and rounds grow with the
logarithm of a component's diameter. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.session import freeze


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of whole numbers -> (a, b): every linked node but the least, and its component's least node.

    Repeated links, links in both directions and links of a node to itself are allowed; links with
    a null are left out. No links give no rows.
    """
    edges = freeze(edges.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return edges
        before = mark
        edges = freeze(_small_star(_large_star(edges)), "links")
