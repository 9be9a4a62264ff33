"""One-shot incremental ingestion: a job that a scheduler starts, that takes what is new and ends."""

from __future__ import annotations

import json
import os
import time
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

#: Where keys are kept between runs: on the executors' disks, with changes in the checkpoint, so memory doesn't bound them.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Locked(RuntimeError):
    """Another run holds the lock; the specification's exit code for it is EXIT_LOCKED."""


class RunLock:
    """The right to run, as a file that is made or refused. A run that died leaves it; after `stale` seconds without a sign of
    life (touch()) another may take it, by a rename that only one of several can do."""

    def __init__(self, spark: SparkSession, path: str, stale: float = 3600):
        self.path, self.stale, self.owner = path, stale, uuid.uuid4().hex
        self._place = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._place(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _make(self) -> bool:
        """A draft is renamed, or linked on local disks, without overwriting: of two runs one is refused, where that is one step."""
        draft = self._place(f"{self.path}.{self.owner}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps({"owner": self.owner, "since": time.time()}).encode()))
        finally:
            stream.close()
        target = self._place(self.path)
        try:
            if self._fs.getScheme() == "file":
                try:
                    os.link(draft.toUri().getPath(), target.toUri().getPath())
                    made = True
                except FileExistsError:
                    made = False
            else:
                made = not self._fs.exists(target) and self._fs.rename(draft, target)
        finally:
            self._fs.delete(draft, False)
        return made and self.holder() == self.owner

    def holder(self) -> str | None:
        """Who holds it, if anyone."""
        try:
            stream = self._fs.open(self._place(self.path))
        except Exception:
            if self._fs.exists(self._place(self.path)):
                raise
            return None
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())["owner"]
        finally:
            stream.close()

    def touch(self) -> None:
        """A sign of life."""
        now = int(time.time() * 1000)
        self._fs.setTimes(self._place(self.path), now, now)

    def __enter__(self) -> RunLock:
        if self._make():
            return self
        place = self._place(self.path)
        try:
            old = time.time() - self._fs.getFileStatus(place).getModificationTime() / 1000 > self.stale
        except Exception:  # it was given back in between
            old = False
        if old:
            gone = self._place(f"{self.path}.{self.owner}.stale")
            if self._fs.rename(place, gone):
                self._fs.delete(gone, False)
        if not (old and self._make()):
            raise Locked(f"another run holds {self.path}")
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if self.holder() == self.owner:
            self._fs.delete(self._place(self.path), False)


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str) -> int:
    """Add rows of new files under source to target (Parquet), each key once; how many were added.

    Keys that earlier runs have added are in the query's state, by hash in as many parts as the first run has shuffle partitions:
    a run looks its own keys up there and reads nothing of target. A null key is one key. Started again without new files it
    adds nothing. A batch that died and comes again replaces its own folder. Two runs at once: the second is refused (Locked),
    before any work. target is written by this job alone, with this checkpoint.
    """
    added = [0]
    with RunLock(spark, f"{checkpoint.rstrip('/')}.lock") as lock:

        def batch(rows: DataFrame, number: int) -> None:
            part = f"{target.rstrip('/')}/batch={number}"
            rows.write.mode("overwrite").parquet(part)
            lock.touch()
            added[0] += spark.read.schema(rows.schema).parquet(part).count()

        before = spark.conf.get(_PROVIDER, None)
        spark.conf.set(_PROVIDER, STATE_STORE)
        try:
            rows = spark.readStream.schema(schema).parquet(source).dropDuplicates([key])
            rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        finally:
            spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    return added[0]
