"""Connected components of a graph whose links are rows, by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.sources.tables import keep


def components(links: DataFrame) -> DataFrame | None:
    """(node, root) of every node that has a link, from links (a, b) of long ids; None without links.

    In each round every node moves to the neighbour, itself included, with the smallest value of a
    hash that is fresh in that round; links are carried along and those inside a node vanish. A
    constant share of the nodes is expected to go each round whatever the shape of the graph. A
    node with very many links is only ever the key of an aggregate that combines before the shuffle,
    or of the large side of a join with one row per key, which Spark splits.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = keep(both.where("a <> b").distinct(), "edges")
    moves = []
    while not edges.isEmpty():
        salt = F.lit(len(moves))
        best = edges.groupBy("a").agg(F.min(F.struct(F.xxhash64(salt, "b").alias("h"), F.col("b"))).alias("m"))
        own = F.struct(F.xxhash64(salt, "a").alias("h"), F.col("a").alias("b"))
        moved = keep(best.select(F.col("a").alias("node"), F.least("m", own)["b"].alias("root")), "moves")
        moves.append(moved)
        left = moved.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = moved.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        carried = edges.join(left, "a").join(right, "b").where("ra <> rb")
        edges = keep(carried.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if not moves:
        return None
    final = moves.pop()
    while moves:
        later = final.select(F.col("node").alias("root"), F.col("root").alias("last"))
        final = moves.pop().join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return final
