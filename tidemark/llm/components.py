"""Connected components by alternating large and small stars, one written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``, as a table of its own: the join that follows then
    shuffles both sides, so a centre with very many neighbours can be split."""
    return settle(edges.groupBy("u").agg(F.min("v").alias("m")), "lowest")


def _star(edges: DataFrame) -> DataFrame:
    """One round on edges ``u > v``: every node moves its neighbours to the smallest it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = _lowest(both).withColumn("m", F.least("u", "m"))
    large = (
        both.join(lowest, "u")
        .where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    large = settle(large.distinct(), "large")
    lowest = _lowest(large)
    small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = small.where("u != v").unionByName(lowest.withColumnRenamed("m", "v"))
    return settle(small.distinct(), "small")


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum: equal for two rounds exactly when nothing moved."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node that has an edge and is not the smallest of its component,
    with that smallest node. ``edges`` are pairs ``u``, ``v`` in any direction.

    The number of rounds grows with the logarithm of the longest path. Edges never grow in number.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = settle(pairs.where("u != v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = _star(edges)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
