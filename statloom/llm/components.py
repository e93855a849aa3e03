"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    low = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    spread = down.join(low, F.col("a") == F.col("u"))
    ends = spread.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return ends.where("a > b")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node with an edge (a, b).

    Each round hangs every neighbourhood below its smallest member, first from the larger side, then
    from the smaller one, until the edges are stars. Minima are combined in each task and the joins can
    be split by Spark, so a node with very many links is no single task. Two figures reach the driver.
    """
    edges = stage(edges.select("a", "b").where("a <> b").distinct())
    seen = None
    while True:
        edges = stage(_small_star(_large_star(edges)).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
