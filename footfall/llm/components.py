"""Connected components as alternating star contractions over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.stages import stage


def _signature(edges: DataFrame):
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, neighbours: DataFrame, keep) -> DataFrame:
    """Connects the ``keep`` neighbours of every node to its smallest one.

    The minima are a table of their own, so the join reads two plain inputs
    and a hub's rows can be split over tasks."""
    minima = stage(
        neighbours.groupBy("u").agg(F.min("v").alias("m0"))
        .select("u", F.least("u", "m0").alias("m")), "star")
    return edges.join(minima, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``).

    ``root`` is the smallest node of the component.  Large-star and small-star
    rounds (edges shrink to one star per component in O(log n) rounds for the
    usual graphs); every round is written to the shared folder and only its row
    count and checksum reach the driver.  Nulls and self-links are dropped; an
    empty table gives an empty table.
    """
    current = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    seen = _signature(current)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, both, F.col("v") > F.col("u")).where("u <> v").distinct()
        large = stage(large, "large")
        small = (_star(large, large, F.lit(True)).where("u <> v")
                 .union(large.groupBy("u").agg(F.min("v").alias("v"))).distinct())
        current = stage(small, "small")
        now = _signature(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(current.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
