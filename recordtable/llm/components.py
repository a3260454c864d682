"""Distributed union-find: connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return join_hot(both.where("b > a"), low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_hot(edges, low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node of its component.

    Edges are kept as (larger, smaller) pairs. Every step is a partial
    aggregate plus an N:1 join, both of which stand a node of any degree
    (AQE splits the edge side); each round is written to the shared
    checkpoint folder. Ends when a round changes nothing: then every edge
    joins a node to its root. Rows with a null end and self loops are
    ignored; repeated edges count once; no edges give no rows.
    """
    clean = edges.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = stage(clean.distinct(), "components"), None
    for _ in range(max_rounds):
        seen = Observation()
        step = _small_star(_large_star(current).where("a <> b").distinct()).where("a <> b").distinct()
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        current = stage(step.observe(seen, F.count("*").alias("n"), digest.alias("h")), "components")
        after = (seen.get["n"], seen.get["h"])
        if after == before:
            root = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return root.union(root.select("root", "root").distinct())
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
