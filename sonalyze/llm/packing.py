"""Mixture-controlled packing of documents into training windows.

Every source is a queue of tokens. Deficit round-robin serves the queue that is furthest behind its
share: token t of a source with share p falls due at (t + 1/2) / p, and windows take tokens in due
order. So after any number of windows each source is within a token of its target, the deficit is
carried across windows, and where a partition begins it follows from the queue lengths alone: no
partition waits for another. A source that runs out leaves its share to the others, so every window
but the last is full and holds no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonalyze.llm import text as X
from sonalyze.llm.shared import stored
from sonalyze.llm.tokens import encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
#: Rows of (part, source) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Tokens that one task orders by due time, where there are more queues than tasks are given.
BLOCK_TOKENS = 1 << 20
#: Cells (window, queue) that a task serves at once.
SERVED = 1 << 22
TOKENS = "doc_id long, source string, part int, at long, n long, width int, ids binary"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids of each whole text with the end id, and where they stand in their task's run of their source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = encoder(tokenizer), TaskContext.get().partitionId(), {}
        width, end = encode.kind.itemsize, np.array([end_id], encode.kind).tobytes()
        for batch in batches:
            keys, sources, texts, out, size = batch.column(0), batch.column(1).to_pylist(), batch.column(2), [], 0
            for i in range(batch.num_rows):
                blob = encode.blob(texts[i].as_py()) + end
                n, begun = len(blob) // width, at.get(sources[i], 0)
                at[sources[i]] = begun + n
                out.append((keys[i].as_py(), sources[i], part, begun, n, width, blob))
                size += len(blob)
                if size > 4 << 20 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], TOKENS.replace(",", "").split()[::2])
                    out, size = [], 0

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")), F.coalesce("text", F.lit(""))).mapInArrow(X.tidied(run, tokens=True), TOKENS)


class Mixture:
    """served(w): tokens that windows before w took of each queue."""

    def __init__(self, lengths: list[int], shares: list[float], window: int):
        self.n = np.array(lengths, np.float64)
        self.p = np.array(shares, np.float64) / sum(shares)
        self.window, self.total = window, int(sum(lengths))

    def due_before(self, t: np.ndarray) -> np.ndarray:
        return np.clip(np.ceil(t[:, None] * self.p - 0.5), 0, self.n)

    def rank(self, queue: int, token: np.ndarray) -> np.ndarray:
        """About how many tokens come before this one."""
        return self.due_before((token + 0.5) / self.p[queue]).sum(1)

    def served(self, w: np.ndarray) -> np.ndarray:
        want = np.minimum(w * float(self.window), self.total)
        low, high = np.zeros(len(w)), np.full(len(w), float((self.n / self.p).max()) + 1)
        while True:
            mid = (low + high) / 2
            inner = (mid > low) & (mid < high)
            if not inner.any():
                break
            less = self.due_before(mid).sum(1) <= want
            low, high = np.where(inner & less, mid, low), np.where(inner & ~less, mid, high)
        have = self.due_before(low)
        more = self.due_before(high) - have  # due at one moment: in the order of the queues
        left = (want - have.sum(1))[:, None]
        before = np.cumsum(more, 1) - more
        return (have + np.clip(left - before, 0, more)).astype(np.int64)


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, shares: Mapping[str, float] | None = None, alpha: float = 1.0, most_queues: int = 1024) -> DataFrame:
    """Pieces of documents with their window (sequence_id) and place in it.

    docs has doc_id, source, text; other columns are not read. shares: the target proportion of tokens
    by source; a source that shares leaves out gets the least share named. By default a source's target follows its
    tokens to the power of alpha: with 1 all queues end together, with less small sources come up more often until
    they run out. Every source has a queue. Up to most_queues, tasks are given all queues; beyond, tokens are dealt by their due times.
    Null text is the end id alone, null source the source ''; a null doc_id stays null. Repeated rows are packed each. An empty
    table gives no piece. Whole texts of any length are cut across windows.
    """
    spark = docs.sparkSession
    table = stored(tokenized(docs, tokenizer, end_id), "pack-tokens")
    by_part = table.groupBy("part", "source").agg(F.sum("n").alias("n"))
    own = [r["source"] for r in by_part.groupBy("source").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "source").limit(most_queues + 1).collect()]
    if len(own) > most_queues:
        return by_due_time(table, by_part, window, shares, alpha)
    number = {s: i for i, s in enumerate(own)}
    at = by_part.withColumn("queue", F.element_at(F.create_map(*[F.lit(x) for kv in number.items() for x in kv]), F.col("source")) if number else F.lit(None).cast("int"))
    at = at.withColumn("base", F.sum("n").over(Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)))
    lengths = {r["queue"]: r["n"] for r in at.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    if not lengths:
        return spark.createDataFrame([], PIECES)
    sizes = [lengths[q] for q in sorted(lengths)]
    least = min(shares.values()) if shares else 0
    mixture = Mixture(sizes, [shares.get(s, least) for s in own] if shares else [float(n) ** alpha for n in sizes], window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                yield from pieces(batch.slice(lo, 1000), mixture)

    at = at.select("part", "source", "queue", F.coalesce("base", F.lit(0)).alias("base"))
    if at.count() <= BROADCAST_ROWS:
        at = F.broadcast(at)
    return table.join(at, ["part", "source"]).select("doc_id", "source", "queue", (F.col("base") + F.col("at")).alias("at"), "n", "width", "ids").mapInArrow(X.tidied(run, tokens=True), PIECES)


def pieces(batch: pa.RecordBatch, mixture: Mixture) -> Iterator[pa.RecordBatch]:
    """The pieces of some texts. Windows are served SERVED (window, queue) cells at a time at most: rows, and at
    last the tokens of one row, are halved until those that their tokens may lie in are that few."""
    keys, sources = batch.column(0), batch.column(1)
    queue, begin, n, width = (batch.column(i).to_numpy() for i in range(2, 6))
    text = np.cumsum(n) - n
    data = memoryview(np.concatenate([np.frombuffer(b.as_buffer(), "<u2" if k == 2 else "<u4") for b, k in zip(batch.column(6), width)]).astype("<u4")).cast("B")
    most = max(SERVED // len(mixture.n), 16)

    def part(row: np.ndarray, at: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, last = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
        for q in np.unique(queue[row]):
            own = queue[row] == q
            first[own] = np.maximum(mixture.rank(q, at[own]) // mixture.window - 1, 0)
            last[own] = mixture.rank(q, end[own]) // mixture.window + 2
        sparse = last - first >= 4 * (end - at)  # few tokens in many windows: only those around each token
        many = np.where(sparse, 4 * (end - at), last - first + 1).sum() > most
        if many and (len(row) > 1 or end[0] - at[0] > 1):
            if len(row) > 1:
                half = len(row) // 2
                yield from part(row[:half], at[:half], end[:half])
                yield from part(row[half:], at[half:], end[half:])
            else:
                middle = (at + end) // 2
                yield from part(row, at, middle)
                yield from part(row, middle, end)
            return
        edges = [np.arange(a, b + 1) for a, b in zip(first[~sparse], last[~sparse])]
        for i in np.flatnonzero(sparse):
            around = mixture.rank(queue[row[i]], np.arange(at[i], end[i])).astype(np.int64) // mixture.window
            edges.append(np.maximum(around[:, None] + np.arange(-1, 3), 0).ravel())
        edges = np.unique(np.concatenate(edges))
        yield found(row, at, end, edges, mixture.served(edges))

    def found(row: np.ndarray, at: np.ndarray, end: np.ndarray, edges: np.ndarray, served: np.ndarray) -> pa.RecordBatch:
        begun = np.cumsum(np.diff(served, axis=0, append=served[-1:]), 1)  # of a window, behind each queue's part
        own, window = [], []
        for q in np.unique(queue[row]):
            rows = np.flatnonzero(queue[row] == q)
            from_ = np.searchsorted(served[:, q], at[rows], "right") - 1
            count = np.searchsorted(served[:, q], end[rows], "left") - from_
            own.append(np.repeat(rows, count))
            window.append(np.repeat(from_ - (np.cumsum(count) - count), count) + np.arange(count.sum()))
        own, window = np.concatenate(own), np.concatenate(window)
        q = queue[row[own]]
        low = np.maximum(at[own], served[window, q])
        high = np.minimum(end[own], served[window + 1, q])
        full = high > low
        own, window, low, high, q = row[own[full]], window[full], low[full], high[full], q[full]
        before = np.where(q > 0, begun[window, np.maximum(q - 1, 0)], 0)
        lo = (text[own] + low - begin[own]) * 4
        crc = list(map(zlib.crc32, map(data.__getitem__, map(slice, lo.tolist(), (lo + (high - low) * 4).tolist()))))
        columns = [keys.take(pa.array(own)), low - begin[own], high - low, crc, n[own], edges[window], before + low - served[window, q], sources.take(pa.array(own))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 7 else pa.int64()) for k, c in enumerate(columns)], PIECES.replace(",", "").split()[::2])

    yield from part(np.arange(len(n)), begin, begin + n)


def by_due_time(table: DataFrame, by_part: DataFrame, window: int, shares: Mapping[str, float] | None, alpha: float) -> DataFrame:
    """Pieces as of pack, for any number of queues. Time is cut so that about BLOCK_TOKENS fall due in each
    block; texts are cut at the blocks and dealt to them. A block's tokens follow those of the blocks before,
    and its own order gives their windows. Tokens due at one moment are in one block, by source."""
    spark = table.sparkSession
    queues = by_part.groupBy("source").agg(F.sum("n").alias("size"))
    if shares:
        named = spark.createDataFrame([(s, float(p)) for s, p in shares.items()], "source string, p double")
        queues = queues.join(named, "source", "left").withColumn("p", F.coalesce("p", F.lit(float(min(shares.values())))))
    else:
        queues = queues.withColumn("p", F.pow(F.col("size").cast("double"), F.lit(alpha)))
    queues = stored(queues, "pack-queues")
    ends = queues.withColumn("end", F.col("size") / F.col("p")).groupBy(F.floor(F.log2("end") * 16).alias("bin")).agg(F.sum("p").alias("p"), F.sum("size").alias("n"), F.max("end").alias("end")).orderBy("end").collect()
    total, rate, served, time = sum(r["n"] for r in ends), sum(r["p"] for r in ends), [0.0], [0.0]
    for r in ends:
        served.append(served[-1] + max(rate, 0) * (r["end"] - time[-1]))
        time.append(r["end"])
        rate -= r["p"]
    targets = np.arange(1, -(-total // BLOCK_TOKENS)) * BLOCK_TOKENS
    cuts = np.unique(np.interp(targets * (served[-1] / total), served, time))

    def parts(at: np.ndarray, n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, block, first token and end of each part of the texts."""
        first = np.searchsorted(cuts, (at + 0.5) / p, "right")
        count = np.searchsorted(cuts, (at + n - 0.5) / p, "right") - first + 1
        row = np.repeat(np.arange(len(n)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        block, low, high = first[row] + step, at[row], at[row] + n[row]
        inner = np.flatnonzero(step > 0)
        cut, share = cuts[block[inner] - 1], p[row[inner]]
        begin = np.ceil(cut * share - 0.5).astype(np.int64)
        begin -= (begin - 0.5) / share >= cut  # as the division rounds
        begin += (begin + 0.5) / share < cut
        low[inner] = begin
        high[inner - 1] = begin
        full = high > low
        return row[full], block[full], low[full], high[full]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, block, low, high = parts(*(batch.column(i).to_numpy() for i in range(3)))
            n = np.bincount(block, high - low).astype(np.int64)
            full = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(n[full])], ["block", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                at, n, p, width = (batch.column(i).to_numpy() for i in range(4))
                row, block, low, high = parts(at, n, p)
                blobs = batch.column(6).to_pylist()
                ids = [blobs[r][a:b] for r, a, b in zip(row.tolist(), ((low - at[row]) * width[row]).tolist(), ((high - at[row]) * width[row]).tolist())]
                columns = [block, low, high - low, low - at[row], n[row], p[row], width[row], batch.column(4).take(pa.array(row)), batch.column(5).take(pa.array(row)), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    schema = "block long, at long, n long, start long, doc_tokens long, p double, width int, doc_id long, source string, ids binary"
    names = schema.replace(",", "").split()[::2]
    base = by_part.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "source", "base").join(queues.select("source", "p"), "source")
    rows = table.join(base, ["part", "source"]).withColumn("at", F.col("base") + F.col("at"))
    counted = {r["block"]: r["n"] for r in rows.select("at", "n", "p").mapInArrow(sizes, "block long, n long").groupBy("block").agg(F.sum("n").alias("n")).collect()}
    before = np.cumsum([0, *(counted.get(k, 0) for k in range(len(cuts) + 1))])

    def packed(key: tuple, got: pa.Table) -> pa.Table:
        begun = int(before[key[0].as_py()])
        at, n, start, doc_tokens, p, width = (got.column(c).to_numpy() for c in ("at", "n", "start", "doc_tokens", "p", "width"))
        sources = got.column("source").to_pylist()
        number = {s: i for i, s in enumerate(sorted(set(sources)))}
        queue = np.array([number[s] for s in sources], np.int64)
        row, first = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
        token = at[row] + np.arange(len(row)) - first[row]
        rank = np.empty(len(row), np.int64)
        rank[np.lexsort((queue[row], (token + 0.5) / p[row]))] = begun + np.arange(len(row))
        edges = X.group_starts(row, rank // window)
        begin, length = edges[:-1], np.diff(edges)
        own, place = row[begin], rank[begin] // window
        by = np.lexsort((token[begin], queue[own], place))
        offset = np.empty(len(begin), np.int64)
        offset[by] = (begun + np.cumsum(length[by]) - length[by]) % window
        data = memoryview(np.concatenate([np.frombuffer(b.as_buffer(), "<u2" if k == 2 else "<u4").astype("<u4") for b, k in zip(got.column("ids"), width)])).cast("B")
        crc = [zlib.crc32(data[a:b]) for a, b in zip((begin * 4).tolist(), (edges[1:] * 4).tolist())]
        keys, named = (got.column(c).take(pa.array(own)) for c in ("doc_id", "source"))
        return pa.table([keys, start[own] + begin - first[own], length, pa.array(crc, pa.int64()), doc_tokens[own], place, offset, named], PIECES.replace(",", "").split()[::2])

    return rows.select("at", "n", "p", "width", "doc_id", "source", "ids").mapInArrow(X.tidied(cut, tokens=True), schema).groupBy("block").applyInArrow(packed, PIECES)
