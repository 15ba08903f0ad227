"""Connected components of a table of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.session import written


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b``): the smallest node it is connected to.

    Rounds of large stars and small stars: each node hands its larger neighbours,
    then its smaller ones, to the smallest neighbour. Links never become more,
    and the number of rounds grows with the logarithm of the longest path. Every
    round reads a written table; only a count and a checksum come to the driver.
    """
    edges = written(_down(links.where("a <> b")), "stars")
    before = None
    while True:
        small = written(_down(_star(_both_ways(edges))), "stars")
        edges = written(_down(_star(small.select(F.col("a").alias("u"), F.col("b").alias("v")), own=True)), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _down(links: DataFrame) -> DataFrame:
    """Distinct links from the larger node ``a`` to the smaller ``b``."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _star(near: DataFrame, own: bool = False) -> DataFrame:
    """Links of neighbours to the smallest neighbour of their node ``u``.

    All larger ones of both directions, or, with ``own``, all smaller ones and the
    node itself.
    """
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = near.join(least, "u")
    if own:
        return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    )
