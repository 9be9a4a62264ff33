"""Connected components by alternating stars: a large-star step links each id's greater neighbours to the least of them all,
a small-star step each id and its lesser neighbours to the least of these, until every component is a star around its least id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonalyze.shared import cut


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: a, b long. Returns id and component (the least id reachable) of each id that has a link to another. Each round is
    checkpointed; an id of very many links is a skewed key of plain joins, which Spark splits. No links give an empty result."""
    now = cut(links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct())
    mark = None
    while True:
        now = cut(_small(_large(now)))
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
