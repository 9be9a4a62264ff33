"""Ledger tables, technical logs and scripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK = "task_id long, module string, operation string, trigger string, actor string, path_type string, status string, design string, started_at timestamp_ntz, ended_at timestamp_ntz, exit_code int, workflow string, version int, lock_domain string, executor string, snapshot string"
STAGE = "stage_id long, task_id long, stage_key string, attempt_no int, expected_seq int, actual_seq int, status string, started_at timestamp_ntz, ended_at timestamp_ntz, unit string, input long, output long, routes map<string,bigint>, snapshot string"


def tasks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TASK).parquet(path)


def stages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGE).parquet(path)


def from_database(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A ledger table of a database, read in ranges of its key; the driver class must be on the class path."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, **options)
    return reader.load()


def logs(spark: SparkSession, paths: list[str], key: str, field: str = "correlation_id") -> DataFrame:
    """Lines of current and rotated JSON logs that carry a correlation key, with their file."""
    rows = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file"))
    return rows.where(F.col("value").contains(key)).where(F.get_json_object("value", f"$.{field}") == key)


def scripts(spark: SparkSession, path: str, newest: bool = False) -> DataFrame:
    """path, value, modified of Markdown scripts; the newest alone if asked."""
    rows = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_modification_time").alias("modified"))
    return rows.orderBy(F.desc("modified"), F.desc("path")).limit(1) if newest else rows
