"""Connected components of a graph of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer_canon.llm.common import Scratch, cut


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the component is its smallest node.

    Each round hangs the larger neighbours of every node, then the smaller ones, on the smallest of them. That
    keeps components together and ends in one star for each after about as many rounds as the logarithm of the
    longest path. Minima are aggregated before they are shuffled and joined back from a written table, so that
    Spark can split the rows of a node with many edges.
    """
    with Scratch(edges.sparkSession) as scratch:
        down = scratch.keep(
            edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct()
        )
        before, state = None, _state(down)
        while state != before and state[0] > 0:
            down, before = _hung(down, scratch), state
            state = _state(down)
        roots = down.select(F.col("to").alias("node"), F.col("to").alias("component")).distinct()
        return cut(down.select("node", F.col("to").alias("component")).unionByName(roots))


def _state(down: DataFrame) -> tuple:
    return tuple(down.agg(F.count("*"), F.expr("bit_xor(xxhash64(node, to))")).first())


def _hung(down: DataFrame, scratch: Scratch) -> DataFrame:
    # every node's smallest neighbour, itself included, for its larger neighbours
    both = down.unionByName(down.select(F.col("to").alias("node"), F.col("node").alias("to")))
    least = scratch.keep(both.groupBy("node").agg(F.min("to").alias("least")))
    up = down.select(F.col("to").alias("node"), F.col("node").alias("larger"))
    hung = up.join(least, "node").select(F.col("larger").alias("node"), F.least("node", "least").alias("to"))
    down = scratch.keep(hung.where("node <> to").distinct())
    # the smallest of each node's smaller neighbours, for the others and itself
    least = down.groupBy("node").agg(F.min("to").alias("least"))
    hung = down.join(least, "node").select(F.col("to").alias("node"), F.col("least").alias("to"))
    hung = hung.unionByName(least.withColumnRenamed("least", "to"))
    return scratch.keep(hung.where("node <> to").distinct())
