"""Connected components of a graph given as links, by alternating star steps.

Each large-star step points a node's greater neighbours at its least neighbour,
each small-star step points its smaller ones there; a number of rounds that
grows with the logarithm of the longest chain leaves stars. Minima are
aggregated before they move and joined back, so a hub's links stay spread over
tasks. After each step the links are written to the shared folder: that cuts the
lineage, and a lost executor costs only its own tasks of one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import scratch_dir


def stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame, computed once and written to the shared folder."""
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select(
        "u", F.least("u", "w").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Links come as (greater, smaller), so each node's neighbours are smaller."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    turned = (links.join(least, "u").filter("v <> m")
              .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return turned.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(spark: SparkSession, links: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for the nodes of the
    links ``a``, ``b``. A node without links has no row; no links, no rows."""
    now = stored(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .filter("u <> v"), label)
    while True:
        now = stored(spark, _small_star(_large_star(now)), label)
        # Stars: no node that is pointed at points on, and none points twice.
        pointed = now.select(F.col("v").alias("u")).distinct()
        settled = now.join(pointed, "u", "left_semi").isEmpty()
        if settled and now.groupBy("u").count().filter("count > 1").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
