"""Connected components by alternating large-star and small-star steps.

Each step groups by node with map-side combination and joins back, so a node with very
many neighbours is aggregated before the shuffle and its join partition can be split.
Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelmill.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select("v", "m")
    return moved.union(least.select("u", "m")).toDF("a", "b").distinct()


def components(edges: DataFrame, space: Scratch, name: str) -> DataFrame:
    """``(item, component)`` for every item of ``edges (a, b)``; the least item names it."""
    current = space.store(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}0",
    )
    before, turn = None, 0
    while True:
        state = tuple(
            current.agg(
                F.count("*"),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                F.max(F.col("b") >= F.col("a")),
            ).first()
        )
        if state == before:
            break
        before, turn = state, turn + 1
        current = space.store(_small_star(_large_star(current)), f"{name}{turn}")
        if turn > 1:
            space.drop(f"{name}{turn - 2}")
    named = current.select(F.col("a").alias("item"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("item"), F.col("b").alias("component")).distinct()
    return named.union(roots)
