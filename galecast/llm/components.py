"""Connected components of a table of links, by stars in turn: first to larger neighbours, then to smaller ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galecast.llm.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of every node to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("_a"), F.least("a", "least").alias("least"))
    return both.join(least, F.col("a") == F.col("_a")).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of every node, and the node, to the smallest of them; needs a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).where("b <> least")
    return least.select("a", F.col("least").alias("b")).unionByName(others.select(F.col("b").alias("a"), F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in ``links`` (a, b); links to itself are left out.

    Rounds grow with the logarithm of the longest path. Every round is stored,
    so a lost executor costs a part of one round. No rows give no rows.
    """
    larger = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(larger, "links")
    state = None
    while True:
        stars = _small_star(_large_star(edges).distinct()).where("a <> b").distinct()
        edges = written(stars, "stars")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if row == state or not row[0]:
            break
        state = row
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
