"""Connected components of links, by alternating stars; no link or component reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands its larger (large star) or smaller (small star) neighbours its least one."""
    if large:
        flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        beside = edges.unionAll(flipped)
    else:
        beside = edges
    least = beside.groupBy("u").agg(F.min("v").alias("m")) \
        .select("u", F.least("u", "m").alias("m"))
    met = beside.join(least, "u")
    if large:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .unionAll(least.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node only, which itself hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionAll(edges.select(F.col("v"), F.lit(0), F.lit(1)))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where("up > 1 or up > 0 and down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of `links` (bigint columns a, b)."""
    edges = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _are_stars(edges):
        stars = _star(_star(edges, large=True), large=False).where("u <> v").distinct()
        edges = materialize(stars, "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
