"""Connected components of an edge table by repeated contraction.

In a round every node joins the node of least hash among itself and its neighbours; what was joined becomes one node,
and edges inside it vanish.  A fresh hash each round leaves a fixed share of the nodes on average, so the rounds grow with
the logarithm of the graph, also for long chains.  The joins of the rounds are then followed back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v), in one direction or both, loops and repeats allowed, to (node, component): the smallest node that
    can be reached, for every node that has an edge to another."""
    e = materialize(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    moves = []
    while e.limit(1).count():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        seed = F.lit(len(moves))
        rank = lambda c: F.struct(F.xxhash64(c, seed).alias("h"), F.col(c).alias("n"))
        move = materialize(both.groupBy("u").agg(F.min(rank("v")).alias("best"))
                           .select(F.col("u").alias("node"), F.least(rank("u"), F.col("best"))["n"].alias("to")))
        moves.append(move)
        one = e.join(move.select(F.col("node").alias("u"), F.col("to").alias("x")), "u")
        two = one.join(move.select(F.col("node").alias("v"), F.col("to").alias("y")), "v")
        e = materialize(two.where("x <> y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct())
    if not moves:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = moves[0]
    for move in moves[1:]:
        found = found.join(move.select(F.col("node").alias("to"), F.col("to").alias("_on")), "to", "left") \
            .select("node", F.coalesce("_on", "to").alias("to"))
    found = materialize(found)
    least = found.groupBy("to").agg(F.min("node").alias("component"))
    return found.join(least, "to").select("node", "component")
