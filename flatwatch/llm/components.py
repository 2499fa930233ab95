"""Connected components of an edge table by repeated contraction, on DataFrame joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatwatch.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; nodes of one component share one root, itself a node.

    Each round every node moves to the least node of its closed neighbourhood, in an order drawn anew per round
    (a hash of node and round), and the edges are rewritten to the new names. Neighbours keep a path between
    their new names, so components never change, and the number of nodes falls by a constant factor in
    expectation: about log(n) rounds. Minima aggregate on the map side and the joins are ordinary shuffle joins,
    whose skewed keys (a hub) AQE splits; nothing is gathered per node. Rounds are written to the shared
    checkpoint folder, so a lost executor repeats one round at most. Self-loops and nulls are ignored; an empty
    edge table gives no rows.
    """
    live = materialize(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                       .filter(F.col("a") != F.col("b")).distinct(), "cc-edges")
    names = live.select(F.col("a").alias("node")).union(live.select(F.col("b").alias("node"))).distinct()
    names = materialize(names.withColumn("root", F.col("node")), "cc-names")
    turn = 0
    while not live.isEmpty():
        turn += 1
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("n"))
        least = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        moves = materialize(least.select(F.col("a").alias("was"), F.least(rank(F.col("a")), F.col("m"))["n"].alias("now")),
                            "cc-moves")
        names = materialize(
            names.join(moves, names["root"] == moves["was"], "left")
            .select("node", F.coalesce("now", "root").alias("root")), "cc-names")
        first = live.join(moves, live["a"] == moves["was"]).select(F.col("now").alias("a"), "b")
        second = first.join(moves, first["b"] == moves["was"]).select("a", F.col("now").alias("b"))
        live = materialize(second.filter(F.col("a") != F.col("b"))
                           .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                           "cc-edges")
    return names
