"""Connected components of a link table, as DataFrame jobs (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                    .alias("x")).select("x.a", "x.b")


def _large_star(e: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    n = _both(e)
    least = n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return n.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest of them."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, label) for every node of ``links`` (a, b: long), label the smallest node of its component.

    Each step joins on node ids, so a node with very many links is a skewed join key, which AQE splits; minima are
    combined before the shuffle. The number of steps grows with the logarithm of the component size.
    """
    e = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
              "links")
    before = _state(e)
    while before[0]:
        old, e = e, stage(_small_star(_large_star(e)).distinct(), "links")
        discard(old)
        now = _state(e)
        if now == before:
            break
        before = now
    nodes = e.select("a", F.col("b").alias("label"))
    return nodes.unionByName(e.select(F.col("b").alias("a"), F.col("b").alias("label")).distinct())
