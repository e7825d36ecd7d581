"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import stored


def _both(links: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """u, v twice for each row, from two pairs of its columns; ``links`` are read once, which keeps the plans short."""
    sides = [F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in (first, second)]
    return links.select(F.explode(F.array(*sides)).alias("side")).select("side.u", "side.v")


def _minima(directed: DataFrame) -> DataFrame:
    """Each link u, v with the smallest of u and its neighbours; the minimum is formed before the shuffle."""
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return directed.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest one; u > v in all links."""
    return _minima(_both(links, ("u", "v"), ("v", "u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the smallest one; ``links`` have u > v."""
    return _both(_minima(links), ("v", "m"), ("u", "m")).where("u <> v").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one."""
    ends = _both(links, ("u", "v"), ("v", "u"))
    return ends.groupBy("u").agg(
        F.count_if(F.col("v") < F.col("u")).alias("down"), F.max((F.col("v") > F.col("u")).cast("int")).alias("up")).where(
        "down > 1 OR down = 1 AND up = 1").isEmpty()


def shortened(links: DataFrame) -> DataFrame:
    """u, v with u > v: links of the same components, as stars around their smallest nodes."""
    links = links.select("u", "v").where("u <> v")
    while True:
        links = stored(_small_star(_large_star(links)), "stars")
        if _are_stars(links):
            return links


def labels(links: DataFrame) -> DataFrame:
    """node, root for each node of ``shortened`` links: the smallest node of its component."""
    rooted = _both(links, ("u", "v"), ("v", "v"))
    return rooted.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
