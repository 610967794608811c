"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultsift.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, keep: str) -> DataFrame:
    """Links each node's neighbours to the least node around it.

    The least node is a partial minimum, joined back, so that a hub with very
    many neighbours is never collected; its join can be split by Spark.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("w", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("w")).where(keep).select("u", "v", "m")


def _large(edges: DataFrame) -> DataFrame:
    linked = _star(_both_ways(edges), "v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _star(down, "true")
    pairs = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    pairs = pairs.union(linked.select("u", F.col("m").alias("v")))
    return pairs.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and checksum: two equal edge sets have the same."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have an edge; the component is its least node.

    ``edges`` has columns u and v, in any order and with repeats. Large and
    small stars alternate until nothing changes, which takes about the
    logarithm of the longest path; every round is staged.
    """
    edges = staged(edges.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        edges = staged(_small(_large(edges)), "stars")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
