"""Removal of byte strings that occur earlier in the corpus, by suffix arrays.

Each string of `window` bytes has an anchor, the least hashed of the shorter strings in it, which equal
strings share at the same distance. A run of strings with one anchor is a context. Count-min sketches,
merged by range of cells, tell which anchors may be repeated; contexts of the others hold nothing that
repeats. The contexts left are dealt by their anchor, so that equal strings meet in one part; equal contexts are one. Each part is
cut into shards of bounded size. A shard's suffix array (Larsson-Sadakane) and common prefixes (Kasai)
give the classes of equal strings, shards that hold the same anchor are merged by binary search of the
strings of one in the suffixes of the other, and all but the earliest of a class are removed.

An anchor that very many blocks of texts hold (a line that a third of all documents have, in as many
surroundings) would make one part too large. The sketches, which have two cells a key at any size, tell all
tasks these anchors by their counts; their strings are dealt one by one, by two 64-bit hashes of their own,
and grouped exactly by these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonalyze.llm import suffixes as S
from sonalyze.llm import text as X
from sonalyze.llm.shared import n_buckets, stored
from sonalyze.llm.sketch import Blocks, Sketch, text_bytes
from sonalyze.llm.substrings import by_block, joined, later, named, parted, placed, record

SHARD_BYTES = 1 << 19
#: Bytes of text that a part is made for.
PART_BYTES = 8 << 20
#: An anchor is hot if its count in the sketches, two a block at most, is 2 ** HOT or more.
HOT = 7
#: what 0: contexts for a part; 1: strings of hot anchors, with hashes c1 and c2; 2: runs of strings to be removed.
FOUND = "part int, block int, what int, row binary, start binary, n binary, anchor binary, c1 binary, c2 binary, body binary, rows binary, docs binary"
REMOVED = "block int, row binary, start binary, n binary"


def contexts(c: X.Chunk, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: the first start, how many, the anchor's hash."""
    short = max(1, window * 8 // 25)
    starts = X.inside(c.offsets, len(c.data), window)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    grams = X.windows(X.BYTE_CODE[c.data], short, X.BASE_BYTE)
    place = X.anchors(grams, window - short + 1)[starts]
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return starts[new], np.diff(np.append(new, len(starts))), grams[place[new]]


def bodies(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the spans, one after another."""
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class Shard:
    """Classes of equal windows in some contexts, in suffix order, with the first place of each."""

    def __init__(self, body: np.ndarray, n: np.ndarray, doc: np.ndarray, start: np.ndarray, at_row: np.ndarray, window: int):
        lengths = n + window - 1
        at = np.cumsum(lengths) - lengths
        data = body
        self.keys = S.words8(data)
        sa = S.suffix_array(self.keys, len(data))
        prefix = S.common_prefixes(data, self.keys, sa)
        context = np.repeat(np.arange(len(n)), lengths)
        inner = np.arange(len(data)) - at[context]
        mine = inner[sa] < n[context[sa]]
        number = np.cumsum(prefix < window)[mine]
        self.place = sa[mine]
        self.edges = X.group_starts(number)
        self.row = at_row[context[self.place]]
        self.doc, self.start = doc[context[self.place]], start[context[self.place]] + inner[self.place]
        self.cls = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))
        by = np.lexsort((self.start, self.doc, self.cls))[self.edges[:-1]]
        self.first = np.stack([self.doc[by], self.start[by]])
        self.least = self.first.copy()

    def meet(self, other: Shard, window: int) -> None:
        """Let equal classes of both know the earlier place."""
        own = self.place[self.edges[:-1]]
        at = S.find(self.keys, own, other.keys, other.place[other.edges[:-1]], window)
        theirs = np.flatnonzero(at >= 0)
        mine = at[theirs]
        for a, i, b, j in ((self, mine, other, theirs), (other, theirs, self, mine)):
            now, seen = a.least[:, i], b.first[:, j]
            earlier = (seen[0] < now[0]) | ((seen[0] == now[0]) & (seen[1] < now[1]))
            a.least[:, i[earlier]] = seen[:, earlier]

    def removed(self) -> tuple[np.ndarray, np.ndarray]:
        doc, start = self.least[:, self.cls]
        gone = (self.doc != doc) | (self.start != start)
        return self.row[gone], self.start[gone]


def runs(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive starts as (row, first, count)."""
    by = np.lexsort((start, row))
    row, start = row[by], start[by].astype(np.int64)
    new = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)) if len(row) else np.empty(0, bool)
    at = np.flatnonzero(new)
    return row[at], start[at].astype(np.uint32), np.diff(np.append(at, len(row))).astype(np.uint32)


def later_windows(doc: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray, anchor: np.ndarray, c1: np.ndarray, c2: np.ndarray, body: np.ndarray, window: int, shard_bytes: int = SHARD_BYTES) -> Iterator[tuple[np.ndarray, ...]]:
    """Of the contexts of one part, the windows that start earlier too, as (row, first start, count)."""
    start = start.astype(np.int64)
    by, gone = later(c1, c2, doc, start)
    gone, own = by[gone], by[~gone]
    yield row[gone], start[gone].astype(np.uint32), n[gone].astype(np.uint32)
    own = own[np.argsort(anchor[own], kind="stable")]
    edges = X.group_starts(anchor[own])
    own = own[np.repeat(np.diff(edges) > 1, np.diff(edges))]
    n = n.astype(np.int64)
    lengths = n + window - 1
    at = np.cumsum(lengths) - lengths
    size = np.cumsum(lengths[own])
    cuts = np.unique(np.append(np.searchsorted(size, np.arange(0, int(size[-1]) if len(size) else 0, shard_bytes)), len(own)))
    open_: list[tuple[Shard, np.uint64]] = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        mine = own[a:b]
        shard = Shard(bodies(body, at[mine], lengths[mine]), n[mine], doc[mine], start[mine], row[mine], window)
        if open_ and open_[-1][1] != anchor[mine[0]]:
            for s, _ in open_:
                yield runs(*s.removed())
            open_ = []
        for s, last in open_:
            s.meet(shard, window)
        open_.append((shard, anchor[mine[-1]]))
    for s, _ in open_:
        yield runs(*s.removed())


def dedup_bytes(docs: DataFrame, window: int = 100, max_bits: int = 62, hot: int = HOT) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans and kept (the bytes that stay, binary).

    A byte goes when a string of `window` bytes of its document's UTF-8 text that covers it starts earlier
    too: in a smaller doc_id, or earlier in the same document. n_spans counts the maximal runs of removed
    bytes. Strings are judged on the texts given. All columns are kept; the four new ones take the place of
    columns of that name. Null text is empty. Rows of one doc_id are one document at one place: of equal
    strings that start at the same byte, neither is earlier. A null doc_id comes before all others.
    """
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept")
    total = text_bytes(docs)
    parts, blocks = n_buckets(docs.sparkSession, total, PART_BYTES), Blocks(docs.select("doc_id", "text"), total)

    def keys(column: pa.Array) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *(contexts(c, window)[2] for c in X.chunks(column))])

    sketch = Sketch(blocks, keys, total * 2 // window, rows=2, max_bits=max_bits)

    def found(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        X.trim()
        block, (ids, texts), repeats = key[0].as_py(), blocks.distinct(table), sketch.heard(answers)
        got: list[list[np.ndarray]] = [[np.empty(0, k)] for k in (np.uint32, np.uint32, np.uint32, np.uint64, np.uint64, np.uint64, np.uint8)]
        single: list[list[np.ndarray]] = [[np.empty(0, k)] for k in (np.uint64, np.uint64, np.uint32, np.uint32)]
        for c in X.chunks(texts):
            starts, n, anchor = contexts(c, window)
            if not len(starts):
                continue
            level = repeats.level(anchor)
            live = level > 0
            starts, n, anchor, crowd = starts[live], n[live], anchor[live], level[live] >= hot
            row = np.searchsorted(c.offsets, starts, "right") - 1
            ends = starts + n + window - 1
            codes = X.BYTE_CODE[c.data]
            sums, sums2 = X.prefix(codes, X.BASE_BYTE), X.prefix(X.mix(codes), X.BASE_ALT)
            if crowd.any():
                at = np.repeat(starts[crowd] - (np.cumsum(n[crowd]) - n[crowd]), n[crowd]) + np.arange(n[crowd].sum())
                own = np.repeat(row[crowd], n[crowd])
                for out, x in zip(single, (X.spans(sums, at, at + window, X.BASE_BYTE), X.spans(sums2, at, at + window, X.BASE_ALT), (c.first + own).astype(np.uint32), (at - c.offsets[own]).astype(np.uint32))):
                    out.append(x)
                starts, n, anchor, row, ends = starts[~crowd], n[~crowd], anchor[~crowd], row[~crowd], ends[~crowd]
            for out, x in zip(got, ((c.first + row).astype(np.uint32), (starts - c.offsets[row]).astype(np.uint32), n.astype(np.uint32), anchor, X.spans(sums, starts, ends, X.BASE_BYTE), X.spans(sums2, starts, ends, X.BASE_ALT), bodies(c.data, starts, ends - starts))):
                out.append(x)
        return record([*dealt(block, ids, *map(np.concatenate, got)), *dealt_singly(block, ids, *map(np.concatenate, single))], FOUND)

    def removal(block: int, row: np.ndarray, start: np.ndarray, n: np.ndarray) -> list[tuple]:
        return [(block % parts, block, 2, row.tobytes(), start.tobytes(), n.tobytes(), *[None] * 6)] if len(row) else []

    def dealt_singly(block, ids, h1, h2, row, start) -> Iterator[tuple]:
        by, gone = later(h1, h2, ids[row], start)
        yield from removal(block, *runs(row[by[gone]], start[by[gone]]))
        by = by[~gone]
        part = ((h1[by] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        for p, at in parted(part):
            mine = by[at]
            yield p, block, 1, row[mine].tobytes(), start[mine].tobytes(), None, None, h1[mine].tobytes(), h2[mine].tobytes(), None, *named(row[mine], ids)

    def dealt(block, ids, row, start, n, anchor, c1, c2, body) -> Iterator[tuple]:
        by, gone = later(c1, c2, ids[row], start)
        yield from removal(block, row[by[gone]], start[by[gone]], n[by[gone]])
        own = by[~gone]
        part = ((X.mix(anchor) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # anchors are small hashes
        own = own[np.argsort(part[own], kind="stable")]
        lengths = n.astype(np.int64) + window - 1
        begin = np.cumsum(lengths) - lengths
        for p, at in parted(part[own]):
            mine = own[at]
            yield p, block, 0, *(x[mine].tobytes() for x in (row, start, n, anchor, c1, c2)), bodies(body, begin[mine], lengths[mine]).tobytes(), *named(row[mine], ids)

    def grouped(table: pa.Table) -> pa.Table:
        what = table.column("what").to_numpy()
        out = [table.filter(pa.array(what == 2)).select(["block", "row", "start", "n"])]

        def told(at: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.Table:
            return record(list(by_block(at >> 32, (at & 0xFFFFFFFF).astype(np.uint32), start, n)), REMOVED)

        single = table.filter(pa.array(what == 1))
        block, row, doc = placed(single)
        at, start = (block.astype(np.int64) << 32) | row, joined(single, "start", np.uint32)
        by, gone = later(joined(single, "c1", np.uint64), joined(single, "c2", np.uint64), doc, start)
        out.append(told(*runs(at[by[gone]], start[by[gone]])))
        table = table.filter(pa.array(what == 0))
        block, row, doc = placed(table)
        columns = [joined(table, name, kind) for name, kind in (("start", np.uint32), ("n", np.uint32), ("anchor", np.uint64), ("c1", np.uint64), ("c2", np.uint64), ("body", np.uint8))]
        out += [told(*x) for x in later_windows(doc, (block.astype(np.int64) << 32) | row, *columns, window)]
        return pa.concat_tables(out)

    strings = blocks.grouped().cogroup(sketch.answers().groupBy("block")).applyInArrow(found, FOUND)
    removed = stored(strings.groupBy("part").applyInArrow(grouped, REMOVED), "spans-removed")
    whole = Blocks(docs, total)
    names, at_text = whole.names, whole.at_text

    def cut(texts: pa.Table, gone: pa.Table) -> pa.Table:
        row, start, n = joined(gone, "row", np.uint32), joined(gone, "start", np.uint32).astype(np.int64), joined(gone, "n", np.uint32).astype(np.int64)
        by = np.argsort(row, kind="stable")
        row, start, n = row[by], start[by], n[by]
        number = whole.ranks(texts)[1]
        low, high = np.searchsorted(row, number, "left"), np.searchsorted(row, number, "right")
        counts, kept = [np.zeros(len(number), np.int64) for _ in range(3)], []
        for c in X.chunks(texts.column(at_text)):
            cover = np.zeros(len(c.data) + 1, np.int32)
            for i in range(c.n):
                a, b = low[c.first + i], high[c.first + i]
                if b > a:
                    np.add.at(cover, c.offsets[i] + start[a:b], 1)
                    np.add.at(cover, c.offsets[i] + start[a:b] + n[a:b] + window - 1, -1)
            off = np.cumsum(cover[:-1]) > 0
            begins = off.copy()
            begins[1:] &= ~off[:-1]
            inner = c.offsets[:-1][c.offsets[:-1] < len(off)]
            begins[inner] = off[inner]
            rows = slice(c.first, c.first + c.n)
            counts[0][rows] = np.diff(c.offsets)
            counts[1][rows] = np.diff(np.append(0, np.cumsum(off))[c.offsets])
            counts[2][rows] = np.diff(np.append(0, np.cumsum(begins))[c.offsets])
            stay = np.append(0, np.cumsum(~off))[c.offsets].astype(np.int32)
            kept.append(pa.Array.from_buffers(pa.binary(), c.n, [None, pa.py_buffer(stay.tobytes()), pa.py_buffer(c.data[~off].tobytes())]))
        out = texts.select(list(range(len(names))))
        for name, x in zip(("n_bytes", "n_removed", "n_spans"), counts):
            out = out.append_column(name, pa.array(x))
        return out.append_column("kept", pa.concat_arrays(kept) if kept else pa.array([], pa.binary()))

    schema = T.StructType([*docs.schema.fields, *(T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    return whole.grouped().cogroup(removed.groupBy("block")).applyInArrow(cut, schema)
