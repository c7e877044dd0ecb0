"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valorem.llm.common import sized, stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the least of u and its neighbours."""
    ways = _both_ways(links)
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return ways.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the least of them. ``links`` has a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    tied = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b): root is the least node that is reachable.

    The table is written after each round, so a lost executor repeats one
    round at most; only a row count and a sum reach the driver. Stars are made
    by min and join, so no neighbourhood is gathered in one row. No round makes
    more links than it gets, so each is written in files for the last count.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(sized(ordered, links.count()), "components")
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    seen = None
    while True:
        state = tuple(now.select(mark.alias("s")).first().s)
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = state
        now = stored(sized(_small_star(_large_star(now)), state[0]), "components")
