"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Both are tables of their own, so that a hub's many edges can be split among tasks."""
    return edges.join(least, "u")


def is_star(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u: then each v is the centre of its component."""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return several.isEmpty() and edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) of every node in edges(a, b) that has an edge to another.

    Every round is written to the shared folder; the driver learns whether there are only stars left. Loops, repeated
    and null edges have no effect; no edges give an empty result.
    """
    now = common.written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), (F.col("a") < F.col("b")).alias("x")).filter("x is not null and u <> v").select("u", "v").distinct(), "edges")
    while not is_star(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = common.written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = common.written(star(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least2 = common.written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        pairs = star(large, least2)
        small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(least2.select("u", F.col("m").alias("v"))).distinct()
        after = common.written(small, "edges")
        for old in (now, least, large, least2):
            common.remove(old)
        now = after
    # stars now: u to the centre v
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
