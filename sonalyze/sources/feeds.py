"""Feeds: the items of RSS files, by the file they are in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = "title string, link string, pubDate string"


def feed_items(spark: SparkSession, path: str) -> DataFrame:
    """feed (name of the file without its ending), title, link, published: a row for each item; a blank link is null."""
    rows = spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(path)
    return rows.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("feed"), "title", F.nullif(F.trim("link"), F.lit("")).alias("link"), F.col("pubDate").alias("published"))
