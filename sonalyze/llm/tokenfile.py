"""Files of token ids: documents in ascending order of doc_id, coded in independent, checksummed blocks.

A file is a folder of parts, each with rows of whole documents: their ids (doc_id), lengths, where the row
begins among the ids of its part, and the coded blocks of coder.py. Parts hold ascending ranges of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonalyze.llm.coder import decode_blocks, encode_blocks
from sonalyze.llm.shared import n_buckets
from sonalyze.llm.sketch import text_bytes
from sonalyze.llm.tokens import encoder
from sonalyze.llm.text import ids as integers
from sonalyze.llm.text import tidied

#: Ids in a row, unless one document has more; bytes of text that a part is made for.
ROW_IDS, PART_BYTES = 1 << 23, 24 << 20
#: Parts whose offsets are summed in one task; offsets that are broadcast.
GROUP_PARTS, BROADCAST_ROWS = 4096, 100_000
FILE = "part int, row int, begin long, n_ids long, doc_ids binary, lengths binary, payload binary"
READ = "doc_id long, part int, begin long, n_tokens long, ids binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of each whole text, and end_id after each, to path.

    docs has doc_id and text; other columns are not read. Null text is empty. A null doc_id comes before all
    others. Rows of one doc_id are written each, in an order that follows from their texts. An empty table makes
    an empty file.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = n_buckets(docs.sparkSession, text_bytes(docs), PART_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, row, begin = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], encode.kind).tobytes()
        held: list[bytes] = []
        keys: list[int] = []
        n = 0

        def written() -> pa.RecordBatch:
            lengths = np.array([len(b) // encode.kind.itemsize for b in held], "<u4")
            out = (part, row, begin, n, np.array(keys, "<i8").tobytes(), lengths.tobytes(), encode_blocks(np.frombuffer(b"".join(held), encode.kind)))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(out, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], FILE.replace(",", "").split()[::2])

        for batch in batches:
            texts = batch.column(1)
            for i, key in enumerate(integers(batch.column(0)).tolist()):
                held.append(encode.blob(texts[i].as_py() or "") + end)
                keys.append(key)
                n += len(held[-1]) // encode.kind.itemsize
                if n >= ROW_IDS:
                    yield written()
                    row, begin, n = row + 1, begin + n, 0
                    held, keys = [], []
        if held:
            yield written()

    place = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("text").asc_nulls_first()]
    ranged = docs.repartitionByRange(parts, *place[:2]).sortWithinPartitions(*place)
    ranged.mapInArrow(tidied(run, tokens=True), FILE).write.option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (32-bit little-endian, binary) of a
    file. A damaged block is an error."""
    rows = spark.read.schema(FILE).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, begin = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                keys = np.frombuffer(batch.column(4)[i].as_py(), "<i8")
                lengths = np.frombuffer(batch.column(5)[i].as_py(), "<u4").astype(np.int64)
                found = decode_blocks(batch.column(6)[i].as_py())
                if len(found) != lengths.sum():
                    raise ValueError(f"row {i} of part {part} holds {len(found)} ids, not {lengths.sum()}")
                ends = np.cumsum(lengths)
                for lo in range(0, len(keys), 2000):
                    at = slice(lo, lo + 2000)
                    first, last = ends[lo] - lengths[lo], ends[at][-1]
                    offsets = np.append(0, ends[at] - first).astype(np.int32) * 4
                    ids = pa.Array.from_buffers(pa.binary(), len(keys[at]), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(found[first:last].tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(np.full(len(keys[at]), part, np.int32)), pa.array(begin + ends[at] - lengths[at]), pa.array(lengths[at]), ids], READ.replace(",", "").split()[::2])

    before = offsets(rows.groupBy("part").agg(F.sum("n_ids").alias("n")))
    null = F.lit(-(2**63))
    return rows.mapInArrow(tidied(run), READ).join(before, "part").select(F.nullif("doc_id", null).alias("doc_id"), (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids")


def offsets(sizes: DataFrame) -> DataFrame:
    """part and before (the ids of all parts before it) of sizes (part, n); broadcast if its rows are few. Sums run
    over groups of parts, and within each group."""
    sizes = sizes.withColumn("group", F.expr(f"part div {GROUP_PARTS}"))
    upto = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("group").agg(F.sum("n").alias("n")).select("group", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    within = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    out = sizes.join(groups, "group").select("part", (F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("before"))
    return F.broadcast(out) if sizes.count() <= BROADCAST_ROWS else out
