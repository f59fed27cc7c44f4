"""Connected components of links between ids, by alternating stars of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkledger.llm import common


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked with the node's smallest neighbour."""
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them; pairs are (larger, smaller)."""
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    beside = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(beside).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """Each id that occurs in ``pairs`` (a, b) and is not the smallest of its component, with that smallest id: id, component.

    Null ids and pairs of an id with itself are passed over; repeated pairs are one.  Every round is
    written to the shared folder, so a lost executor costs one round at most.
    """
    now = common.materialize(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if seen["n"] == 0 or mark == (seen["n"], seen["s"]):
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        mark = (seen["n"], seen["s"])
        now = common.materialize(_small_star(_large_star(now)), "links")
