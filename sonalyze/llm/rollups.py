"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of inserts, deletes and revised counts becomes one delta row for each key it touches, and totals are
sums of deltas: no document is counted again. A writer first writes a batch's deltas to a folder of its own, then
names that folder in the batch's claim; the claim is what commits it. So a batch that is sent again, whose first
writer died, or that two writers send at once, counts once. compact() sums exactly the folders that it lists into
a snapshot that remembers them; vacuum() removes them, and the claims stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonalyze.llm.text import tidied
from sonalyze.llm.tokens import encoder

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"
EVENTS = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


def signed(events: DataFrame) -> DataFrame:
    """Delta rows of events (op, source, lang, tokenizer, n_tokens, old_tokens), one for each key.

    insert adds a document of n_tokens, delete takes one of n_tokens away, revise replaces old_tokens by
    n_tokens. Null counts are 0, null keys are a key of their own; repeated rows count each. Another op is
    an error.
    """
    n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    op = F.col("op")
    docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce(op, F.lit("null")))).cast("int"))
    tokens = F.when(op == "insert", n).when(op == "delete", -n).otherwise(n - old)
    rows = events.select(*KEYS, docs.cast("long").alias("docs"), tokens.alias("tokens"))
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """Totals in a folder that all executors share. One writer at a time compacts; any number commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    def _names(self, folder: str) -> list[str]:
        place = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def _put(self, name: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        draft = self._path(f"{self.root}/drafts/{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        place = self._path(f"{self.root}/{name}")
        self._fs.mkdirs(place.getParent())
        self._fs.rename(draft, place)

    def _get(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The last snapshot, if any, and the delta folders it sums; names rise."""
        last = next((n for n in reversed(self._names("snapshots")) if n.endswith(".done")), None)
        return (None, set()) if last is None else (last.removesuffix(".done"), set(self._get(f"snapshots/{last}").split()))

    def _pending(self, folded: set[str]) -> list[str]:
        """Committed delta folders that no snapshot sums yet."""
        return [n for n in self._names("deltas") if n not in folded and self._exists(f"claims/{n.split('~')[0]}") and self._get(f"claims/{n.split('~')[0]}") == n]

    def commit(self, batch_id: str, events: DataFrame) -> bool:
        """Add a batch; False, and no change, if a batch of that id is committed."""
        name = f"b-{quote(batch_id, safe='').replace('~', '%7E')}"
        if self._exists(f"claims/{name}"):
            return False
        folder = f"{name}~{uuid.uuid4().hex}"
        signed(events).write.parquet(f"{self.root}/deltas/{folder}")
        if not self._exists(f"claims/{name}"):
            self._put(f"claims/{name}", folder)
        return self._get(f"claims/{name}") == folder

    def _sum(self, last: str | None, pending: list[str]) -> DataFrame:
        paths = [f"{self.root}/deltas/{n}" for n in pending] + ([f"{self.root}/snapshots/{last}"] if last else [])
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens; keys that are back at no document and no token are left out."""
        last, folded = self._snapshot()
        return self._sum(last, self._pending(folded))

    def compact(self) -> None:
        """Sum the last snapshot and the batches committed since into a new one. What is committed meanwhile is in
        neither its sums nor its list, and counts beside it."""
        last, folded = self._snapshot()
        pending, there = self._pending(folded), set(self._names("deltas"))
        number = int(last.split("-")[0]) + 1 if last else 0
        name = f"{number:012d}-{uuid.uuid4().hex}"
        self._sum(last, pending).write.parquet(f"{self.root}/snapshots/{name}")
        self._put(f"snapshots/{name}.done", "\n".join(sorted(folded & there | {*pending})))

    def vacuum(self) -> None:
        """Remove the delta folders that the last snapshot sums, and older snapshots. Totals that were asked for
        before, and are still to be read, fail."""
        last, folded = self._snapshot()
        old = [n for n in self._names("snapshots") if last and n.split("-")[0] < last.split("-")[0]]
        for name in [*(f"deltas/{n}" for n in folded), *(f"snapshots/{n}" for n in old)]:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)


def word_count(text: str = "text"):
    """Words of a text, parted by ASCII white space."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def byte_count(text: str = "text"):
    return F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")


def id_count(docs: DataFrame, tokenizer: str, name: str = "n_tokens") -> DataFrame:
    """docs (doc_id, source, lang, text) without text, with how many ids the tokenizer gives the whole text; null is
    empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            n = [len(encode.blob(t.as_py() or "")) // encode.kind.itemsize for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64())], ["doc_id", "source", "lang", name])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")
    return own.mapInArrow(tidied(run, tokens=True), f"doc_id long, source string, lang string, {name} long")
