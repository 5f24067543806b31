"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import measured


def _large(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to its smallest neighbour (or to itself): a row per link at most."""
    both = e.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them; that one's own row gives the node's link."""
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("a"), F.col("m").alias("b")).distinct()


def component_stars(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b) but the smallest of each component, which is the others' comp.

    Self links and repeated links change nothing. Each step writes its links to
    the shared folder and learns from the same run whether they still change;
    steps needed grow with the logarithm of a chain's length.
    """
    e = links.where("a <> b").select("a", "b")
    seen = None
    while True:
        e, now = measured(_small(_large(e)), "components", F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes"))
        if now == seen or not now["n"]:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b): comp is the smallest node reachable."""
    stars = component_stars(links)
    return stars.union(stars.select("comp", "comp").distinct())
