"""Count-min sketches that tell which keys may occur more than once, dealt by range of cells.

Rows are in blocks by the hash of their id and text. Each block sketches its keys: the cells they fall in,
with counts up to two, or, where asked for, up to 255. A task merges the counts of one range of cells over all blocks, and answers each block
with those of its own cells that count two or more, and with the logarithm of the count. A merged count
never falls below the true one, so a key whose cell isn't in the answer occurs once at most. There are two
cells a key at any size of the corpus, no task holds more than a range, and nothing is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from sonalyze.llm import text as X
from sonalyze.llm.shared import n_buckets

CELLS_A_KEY, RANGE_BITS = 2, 23
#: Bytes of text that a block is made for.
BLOCK_BYTES = 8 << 20
ASKED = "range long, block int, cells binary, times binary"
ANSWERS = "block int, range long, cells binary, level binary"


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


class Blocks:
    """docs (doc_id, text and others) in blocks by the hash of doc_id and text: rows equal in both are in one
    block, whatever the partitioning, and copies under one id are spread as other rows are."""

    def __init__(self, docs: DataFrame, n_bytes: int, block_bytes: int = BLOCK_BYTES):
        self.names, self.n = docs.columns, n_buckets(docs.sparkSession, n_bytes, block_bytes)
        taken = {c.lower() for c in self.names}
        self.key, self.block = next((f"key{i}", f"block{i}") for i in range(2 * len(taken) + 1) if not taken & {f"key{i}", f"block{i}"})
        self.docs = docs.withColumn(self.key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
        self.at_id, self.at_text = self.names.index("doc_id"), self.names.index("text")

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "docs"}  # workers have the rows

    def grouped(self) -> GroupedData:
        return self.docs.groupBy(F.pmod(F.col(self.key), F.lit(self.n)).cast("int").alias(self.block))

    def ranks(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """The rows of a block that differ in id or text, in order, and each row's number among them. It is
        the same whenever the block is put together again."""
        ids, keys = X.ids(table.column(self.at_id)), table.column(len(self.names)).to_numpy()
        by = np.lexsort((keys, ids))
        edges = X.group_starts(ids[by], keys[by])
        number = np.empty(len(by), np.int64)
        number[by] = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        return by[edges[:-1]], number

    def distinct(self, table: pa.Table) -> tuple[np.ndarray, pa.Array]:
        """Ids and texts of the rows that differ."""
        first, _ = self.ranks(table)
        return X.ids(table.column(self.at_id))[first], X.plain(table.column(self.at_text)).take(pa.array(first))


class Repeats:
    """The cells of one block's keys that hold two keys or more, by row of the sketch, and their counts' logarithms."""

    def __init__(self, bits: int, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.bits, self.rows = bits, [(Places(known), np.append(level, np.uint8(0))) for known, level in rows]

    def level(self, keys: np.ndarray) -> np.ndarray:
        """0: occurs once; else the logarithm of the count, at least 1. It depends on the key alone."""
        out = np.full(len(keys), 255, np.uint8)
        for r, (known, level) in enumerate(self.rows):
            out = np.minimum(out, level[known.of(cells(keys, self.bits, r))])
        return out


class Places:
    """Where values stand among others that are distinct, by hash: lookups in any order cost the same."""

    def __init__(self, values: np.ndarray):
        self.index = pd.Index(values, dtype=np.uint64)

    def of(self, x: np.ndarray) -> np.ndarray:
        """The place of each; -1: none."""
        return self.index.get_indexer(pd.Index(x, dtype=np.uint64)) if len(self.index) and len(x) else np.full(len(x), -1)


def cells(keys: np.ndarray, bits: int, row: int) -> np.ndarray:
    """Keys may be the least of many hashes and so be small; mixed, they fill all cells."""
    return X.mix(keys + np.uint64((row + 1) * X.BASE_ALT % 2**64)) >> np.uint64(64 - bits)


def capped(sorted_cells: np.ndarray) -> np.ndarray:
    """At most two of each."""
    keep = np.ones(len(sorted_cells), bool)
    keep[2:] = sorted_cells[2:] != sorted_cells[:-2]
    return sorted_cells[keep]


def packed(sorted_cells: np.ndarray) -> bytes:
    """The first cell and the gaps, in two bytes each where they fit."""
    gaps = np.diff(sorted_cells)
    small = not len(gaps) or int(gaps.max()) < 1 << 16
    return bytes([small]) + sorted_cells[:1].astype("<u4").tobytes() + gaps.astype("<u2" if small else "<u4").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, "<u2" if blob[0] else "<u4", offset=5)
    out = np.empty(len(gaps) + 1, np.uint32)
    out[0] = np.frombuffer(blob, "<u4", 1, 1)[0]
    out[1:] = gaps
    return np.cumsum(out, dtype=np.uint32)


class Sketch:
    """A sketch of keys(texts) of all blocks; expected: about how many keys there are. least: the logarithm of the count from which a cell is answered."""

    def __init__(self, blocks: Blocks, keys: Callable[[pa.Array], np.ndarray] | None, expected: int, rows: int = 1, max_bits: int = 62, least: int = 1):
        self.blocks, self.keys, self.rows, self.least = blocks, keys, rows, least
        self.bits = int(np.clip(int(max(1, CELLS_A_KEY * expected - 1)).bit_length(), 12, max_bits))
        self.range_bits = min(RANGE_BITS, max(self.bits - 4, 1))

    def ask(self, block: int, found: np.ndarray, counts: np.ndarray | None = None) -> pa.Table:
        """The sketch of one block's keys, by range of cells. counts: which of the keys count; the others are asked about."""
        shift, out = np.uint64(self.range_bits), []
        for r in range(self.rows):
            c, times = cells(found, self.bits, r), None
            if counts is None:
                c = capped(np.sort(c))
            else:
                c = np.sort(c << np.uint64(1) | counts.astype(np.uint64))  # cells have fewer than 63 bits
                c, own = c >> np.uint64(1), c & np.uint64(1)
                at = X.group_starts(c)[:-1]
                c, times = c[at], np.minimum(np.add.reduceat(own, at), 255).astype(np.uint8) if len(c) else np.empty(0, np.uint8)
            part = c >> shift
            edges, c = X.group_starts(part), (c & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.uint32)
            out += [((r << self.bits - self.range_bits) + int(part[a]), block, packed(c[a:b]), None if times is None else times[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], ASKED.replace(",", "").split()[::2])

    def answer(self, part: int, table: pa.Table) -> pa.Table:
        """What the merged counts of one range of cells tell the blocks that have cells in it."""
        held = [unpacked(b.as_py()) for b in table.column("cells")]
        count = np.zeros(1 << self.range_bits, np.uint32)
        for c, times in zip(held, table.column("times")):
            if times.is_valid:  # each cell once
                count[c] += np.frombuffer(times.as_py(), np.uint8)
            else:
                again = np.append(False, c[1:] == c[:-1])
                count[c[~again]] += 1
                count[c[again]] += 1
        level = np.zeros(1 << self.range_bits, np.uint8)
        some = np.flatnonzero(count)
        level[some] = np.log2(count[some]).astype(np.uint8)
        out = []
        for block, c in zip(table.column("block").to_pylist(), held):
            c = c[level[c] >= self.least]
            if len(c):
                c = c[np.append(True, c[1:] != c[:-1])]
                out.append((block, packed(c), level[c].tobytes()))
        columns = ([x[0] for x in out], [part] * len(out), [x[1] for x in out], [x[2] for x in out])
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ANSWERS.replace(",", "").split()[::2])

    def answers(self, asked: DataFrame | None = None) -> DataFrame:
        """For each block, its cells that may hold more than one key. asked: what ask() gave of all blocks."""
        blocks, keys = self.blocks, self.keys

        def ask(key: tuple, table: pa.Table) -> pa.Table:
            return self.ask(key[0].as_py(), keys(blocks.distinct(table)[1]))

        def answer(key: tuple, table: pa.Table) -> pa.Table:
            return self.answer(key[0].as_py(), table)

        if asked is None:
            asked = blocks.grouped().applyInArrow(ask, ASKED)
        return asked.groupBy("range").applyInArrow(answer, ANSWERS)

    def heard(self, answers: pa.Table) -> Repeats:
        """What the answers to one block say."""
        part, rows = answers.column("range").to_numpy(), []
        by = np.argsort(part)
        for r in range(self.rows):
            mine = by[part[by] >> self.bits - self.range_bits == r]
            got = [np.empty(0, np.uint64), *(unpacked(answers.column("cells")[i].as_py()) + (np.uint64(int(part[i]) & (1 << self.bits - self.range_bits) - 1) << np.uint64(self.range_bits)) for i in mine.tolist())]
            rows.append((np.concatenate(got), np.frombuffer(b"".join(answers.column("level")[i].as_py() for i in mine.tolist()), np.uint8)))
        return Repeats(self.bits, rows)
