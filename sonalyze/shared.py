"""The folder that driver and executors share, tables in it, and the package that a session ships to its workers."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_paths: dict[int, tuple[weakref.ref, str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is set, a temporary one if driver and executors are one process,
    and else an error."""
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"{_KEY} names no folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(found)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: its result is in files of its own."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def listed(spark: SparkSession) -> Iterator[None]:
    """Files that are named inside, one by one or by a pattern, are listed by a few tasks for each core, not by one for each file."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * max(1, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """df as a table written to the shared folder and read back: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with freed(spark):
        df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = weakref.ref(out, lambda _, key=id(out): _paths.pop(key, None)), path
    return out


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed, without the shuffle files that it took."""
    with freed(df.sparkSession):
        return df.checkpoint()


def discard(*tables: DataFrame) -> None:
    """Remove tables of stored() that nothing reads any more."""
    for table in tables:
        remove(table.sparkSession, _paths[id(table)][1])


def remove(spark: SparkSession, path: str) -> None:
    """Drop a path that scratch() gave, once nothing reads it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def n_buckets(spark: SparkSession, n_bytes: int, per_bucket: int) -> int:
    """Enough buckets for parts of per_bucket bytes, and for all shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // per_bucket), 1)


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, where the cluster hasn't installed it: an archive in the shared folder."""
    package = Path(__file__).resolve().parent
    name = f"{package.name}-shipped.zip"
    if name in spark.sparkContext._python_includes:
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    to = f"{scratch(spark, 'package')}/{name}"
    place = spark._jvm.org.apache.hadoop.fs.Path(to)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        stream.write(bytearray(held.getvalue()))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(to)
