"""Connected components of an edge table by alternating stars, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (a, b), a > b: link each node's neighbours to the least node it knows.

    Large: the larger neighbours of every node; small: the smaller ones and the
    node itself.  The least neighbour is a partial aggregate and a hub's edges
    meet it in a join Spark can split, so a hub is never gathered in one task.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        linked = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # edges from a node to its smaller neighbours come back from the neighbour's side
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        linked = linked.unionByName(least.select("a", F.col("m").alias("b")))
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node of it) for every node of the edges (a, b); null and loop edges are ignored.

    Each round is written to the shared scratch folder, so lineage stays short
    and a lost executor costs one round.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).head()
        if mark == state:
            break
        state, now = mark, written(_stars(_stars(now, True), False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component")))
