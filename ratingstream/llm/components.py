"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a join-free ``groupBy``: each vertex learns the smallest vertex it is linked
to and links its neighbours to that one. A star's hub may hold a third of all links, so
the minimum is a partial aggregate first and comes back by a join on the vertex; no list of
neighbours is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written


def _minima(e: DataFrame) -> DataFrame:
    return e.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest of its closed neighbourhood."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = _minima(both).withColumn("m", F.least("m", "k"))
    return both.join(m, both["a"] == m["k"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them; links point from larger to smaller."""
    m = _minima(e)
    j = e.join(m, e["a"] == m["k"])
    down = j.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.union(m.select(F.col("k").alias("a"), F.col("m").alias("b")))


def components(spark: SparkSession, links: DataFrame, max_steps: int = 60) -> DataFrame:
    """``links(a, b)`` → ``(a, b)``: every vertex that is linked to a smaller one and the smallest it can reach.

    Vertices missing from the result are their own smallest. Self links, repeated
    links and links with a null end are ignored. Each step is written to the shared
    folder. The number of steps grows with the logarithm of the longest chain; past
    ``max_steps`` it raises rather than return half-merged components.
    """
    e = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(spark, e, "links")
    before = None
    for _ in range(max_steps):
        big = _large_star(e).where("a <> b").distinct()
        e = written(spark, _small_star(big).where("a <> b").distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e
        before = now
    raise RuntimeError(f"components did not settle in {max_steps} steps")
