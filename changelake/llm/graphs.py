"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, scratch, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the smallest node of its component, itself included.

    Each round links every neighbour of a node to the smallest of them (minima are combined before the shuffle), and
    is written to the shared folder; the rounds end when all edges are stars, after about log(diameter) of them. The
    minima are written, too: read again, they are shuffled like the edges, and Spark can split a hub's edges over tasks.
    """
    spark = edges.sparkSession
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    pairs = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    path = scratch(spark, "stars")
    stars = written(pairs(edges), "stars", path)
    before = mark(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least_path = scratch(spark, "least")
        least = written(both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m")), "least", least_path)
        linked = both.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        new_path = scratch(spark, "stars")
        stars = written(pairs(linked.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))), "stars", new_path)
        dropped(spark, path)
        dropped(spark, least_path)
        path, now = new_path, mark(stars)
        if now == before:
            break
        before = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(stars.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root")))
