"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablemill.llm.staged import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _smallest(arcs: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, stored, so that a join to it can split a node with many neighbours."""
    return stage(arcs.groupBy("u").agg(F.min("v").alias("m")), "smallest")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; a component is known by its smallest node.

    ``links`` has columns u and v.  Large-star gives each larger neighbour of a node the smallest one;
    small-star gives the node and its smaller neighbours the smallest one.  Both keep what is connected.
    The edges are stars when neither changes them.  Each step is a grouping with partial minima and a join;
    edges are stored after it.  Loops and repeated links do no harm; without links the result is empty.
    """
    edges = stage(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        arcs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = arcs.join(_smallest(arcs), "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        edges = stage(large.distinct(), "large-star")
        smallest = _smallest(edges)
        small = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
