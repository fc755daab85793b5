"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (u, v): label is the smallest node that can be reached.

    Each round turns larger neighbours to the smallest one, then smaller neighbours to each other's smallest; it ends when
    a round changes no link, after about the logarithm of the largest component. The links of a round are written to the
    shared folder; only their number and checksum come to the driver. The joins are plain, so that adaptive execution
    splits a node with very many links.
    """
    edges = written(_ordered(links), "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        edges = written(_small_star(written(_large_star(edges), "links")), "links")
    # every edge now points from a node to the smallest node of its component
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # the larger neighbours of u: edges (v, u) seen from their smaller end
    return edges.select(F.col("v").alias("u"), F.col("u").alias("far")).join(least, "u").select(
        F.col("far").alias("u"), F.col("m").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and the node itself, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
