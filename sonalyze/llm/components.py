"""Connected components of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonalyze.llm.shared import cut


SALTS = 16


def spread(rows: DataFrame) -> DataFrame:
    """rows with every salt: most links, or labels, may lead to one of them."""
    return rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """links: a, b long. Returns id and component (the least id reachable) of each id that has a link. After a
    number of rounds that is given, ids of one component are connected, but connected ones may have several.

    A round gives each id the least label among its neighbours and itself, then the label of that label;
    paths shorten by half each round. Labels are checkpointed, so no round depends on an executor that is
    gone. No links give an empty result.
    """
    links = links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    both = cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("c")))
    both = both.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    done = 0
    while True:
        near = both.join(spread(labels.select(F.col("id").alias("b"), "c")), ["b", "salt"]).groupBy(F.col("a").alias("id")).agg(F.min("c").alias("m"))
        hooked = labels.join(near, "id").select("id", "c", F.least("c", "m").alias("h"))
        jumped = cut(hooked.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).join(spread(hooked.select(F.col("id").alias("h"), F.col("h").alias("to"))), ["h", "salt"]).select("id", "c", F.least("h", "to").alias("now")))
        labels = jumped.select("id", F.col("now").alias("c"))
        done += 1
        if done == rounds or rounds is None and jumped.where("now <> c").isEmpty():
            return labels.withColumnRenamed("c", "component")
