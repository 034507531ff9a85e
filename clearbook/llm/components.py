"""Connected components of a graph given by its links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.sources.staging import stage


def _stars(links: DataFrame, both_ways: bool) -> DataFrame:
    """Link the neighbours of every node to its smallest neighbour, or to the node if it is smaller.

    With ``both_ways`` only larger neighbours are linked anew, else the smaller
    ones and the node itself. Links run from a larger ``node`` to a smaller
    ``to``. A node with very many neighbours is one row per partition in the
    aggregation, and its join is one that Spark can split.
    """
    if both_ways:
        ways = links.unionByName(links.select(F.col("to").alias("node"), F.col("node").alias("to")))
        smallest = ways.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("smallest"))
        moved = ways.where("to > node").join(smallest, "node").select(F.col("to").alias("node"), "smallest")
    else:
        smallest = links.groupBy("node").agg(F.min("to").alias("smallest"))
        moved = links.join(smallest, "node").where("to <> smallest").select(F.col("to").alias("node"), "smallest")
        moved = moved.unionByName(smallest)
    return moved.select("node", F.col("smallest").alias("to")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, itself included.

    ``links`` has the columns ``a`` and ``b`` (long), one row per link in either
    direction; loops, repeated links and null ends are ignored. Rounds go on
    until every node is linked to its root alone; their number grows with the
    logarithm of the longest path. The links of a round are written to the
    shared folder, so a lost executor costs one round at most.
    """
    larger, smaller = F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")
    current = stage(links.where("a <> b").select(larger, smaller).distinct(), "links")
    while True:
        following = stage(_stars(_stars(current, both_ways=True), both_ways=False), "links")
        # done when no node is both linked to a smaller one and a target, and none has two targets
        state = following.groupBy("node").count().where("count > 1").select("node")
        inner = following.join(following.select(F.col("to").alias("node")).distinct(), "node", "left_semi")
        if state.unionByName(inner.select("node")).isEmpty():
            roots = following.select(F.col("to").alias("node"), F.col("to").alias("root")).distinct()
            return following.select("node", F.col("to").alias("root")).unionByName(roots)
        current = following
