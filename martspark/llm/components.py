"""Connected components of an edge table by alternating large-star and
small-star steps; every step is a grouped minimum and an equi-join, staged in
the shared folder.  No edge or label reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stage import discard, stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _step(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step; the pairs that the first repeats (no more than the edges) leave at the end."""
    return _small_star(_large_star(edges)).where(F.col("u") != F.col("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether all edges lead from a vertex with one edge to a centre, which a further round would not change."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into")))).alias("e"))
    found = ends.groupBy("e.id").agg(F.sum("e.out").alias("out"), F.max("e.into").alias("into"))
    return not found.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).count()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, comp) of every vertex of ``edges`` (u, v); ``comp`` is the smallest id of its component."""
    down = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stage(down.distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(now):
            break
        old, now = now, stage(_step(now), "edges")
        discard(old)
    else:
        raise RuntimeError("components did not settle")
    # a settled table is a set of stars: u -> centre
    roots = now.select(F.col("v").alias("id")).distinct()
    return (now.select(F.col("u").alias("id"), F.col("v").alias("comp"))
            .unionByName(roots.select("id", F.col("id").alias("comp"))))
