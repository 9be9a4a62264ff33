"""Removal of word passages that occur earlier in the corpus.

A window is `window` consecutive words. Its anchor is the least hashed of the shorter word runs in it,
which equal windows share at the same distance, so the windows of a text have far fewer anchors than
windows and a window occurs no more often than its anchor. First pass: count-min sketches of the
anchors, merged by range of cells. Second pass: windows whose anchor is estimated repeated, and no others,
are grouped exactly by two independent 64-bit hashes of their words, and every window but the earliest of
its group marks its words. All passes read the texts by block, from one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonalyze.llm import text as X
from sonalyze.llm.shared import n_buckets
from sonalyze.llm.sketch import Blocks, Sketch, text_bytes

#: Bytes of text a part of windows is made for.
PART_BYTES = 16 << 20
#: Windows of a block for a part (known false), or to be removed from it (known true). row: of the block's rows;
#: rows and docs: the ids of those that occur.
FOUND = "part int, block int, known boolean, h1 binary, h2 binary, row binary, start binary, rows binary, docs binary"
REMOVED = "block int, row binary, start binary"


def anchored(w: X.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows in one text, hashes of the anchors, and each window's anchor as an index."""
    short = max(1, window * 2 // 5)
    starts = X.inside(w.bounds, len(w.starts), window)
    if not len(starts):
        return starts, np.empty(0, np.uint64), starts
    grams = X.windows(w.codes, short, X.BASE_WORD)
    place = X.anchors(grams, window - short + 1)[starts]
    new = np.append(True, place[1:] != place[:-1])
    return starts, grams[place[new]], np.cumsum(new) - 1


def later(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows by hash and place, and which of them, so ordered, start after the first of their group."""
    by = np.lexsort((start, doc, h2, h1))
    edges = X.group_starts(h1[by], h2[by])
    first = by[np.repeat(edges[:-1], np.diff(edges))]
    return by, (doc[by] != doc[first]) | (start[by] != start[first])


def by_block(block: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Columns of what belongs to each block."""
    by = np.argsort(block, kind="stable")
    edges = X.group_starts(block[by])
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(block[by[a]]), *(x[by[a:b]].tobytes() for x in columns)


KINDS = {"int": pa.int32(), "boolean": pa.bool_()}


def record(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = schema.replace(",", "").split()[::2], schema.replace(",", "").split()[1::2]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, KINDS.get(k, pa.binary())) for c, k in zip(columns, kinds, strict=True)], names)


def parted(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of a sorted array."""
    edges = X.group_starts(part)
    return ((int(part[a]), slice(a, b)) for a, b in zip(edges[:-1], edges[1:]))


def named(row: np.ndarray, ids: np.ndarray) -> tuple[bytes, bytes]:
    """The rows that occur, and their ids."""
    rows = np.unique(row)
    return rows.astype(np.uint32).tobytes(), ids[rows].tobytes()


def joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(name) if x.is_valid), kind)


def placed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows or contexts in a part: block, row, and the id of the row's document."""
    rows = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("row")]
    docs = [np.frombuffer(d.as_py(), np.int64)[np.searchsorted(np.frombuffer(k.as_py(), np.uint32), r)] for r, k, d in zip(rows, table.column("rows"), table.column("docs"))]
    block = np.repeat(table.column("block").to_numpy(), [len(r) for r in rows])
    return block, np.concatenate([np.empty(0, np.uint32), *rows]), np.concatenate([np.empty(0, np.int64), *docs])


def dedup_substrings(docs: DataFrame, window: int = 20, max_bits: int = 62, rejoin: bool = True) -> DataFrame:
    """docs with text cut to the words that are kept, joined by one space, and n_words and n_removed.

    A word goes when a window that covers it starts earlier too: in a smaller doc_id, or earlier in the
    same document. Without rejoin, a text that loses no word stays as it is. Windows are judged on the texts given, not on what is left of them. All columns are
    kept; n_words and n_removed take the place of columns of that name. Null text is empty, with no
    words, and stays null. Rows of one doc_id are one document at one place: of equal windows that start at
    the same word, neither is earlier. A null doc_id comes before all others.
    """
    docs = docs.drop("n_words", "n_removed")
    size = text_bytes(docs)
    parts, blocks = n_buckets(docs.sparkSession, size, PART_BYTES), Blocks(docs, size)

    def keys(column: pa.Array) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *(anchored(X.words(c), window)[1] for c in X.chunks(column))])

    sketch = Sketch(blocks, keys, size // 40, rows=2, max_bits=max_bits)

    def found(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        X.trim()
        block, (ids, texts), repeats = key[0].as_py(), blocks.distinct(table), sketch.heard(answers)
        got: list[list[np.ndarray]] = [[np.empty(0, k)] for k in (np.uint64, np.uint64, np.uint32, np.uint32)]
        for c in X.chunks(texts):
            w = X.words(c)
            starts, grams, which = anchored(w, window)
            if not len(starts):
                continue
            starts = starts[(repeats.level(grams) > 0)[which]]
            ends, row = starts + window, w.text[starts]
            for out, x in zip(got, (X.spans(X.prefix(w.codes, X.BASE_WORD), starts, ends, X.BASE_WORD), X.spans(X.prefix(X.mix(w.codes), X.BASE_ALT), starts, ends, X.BASE_ALT), (c.first + row).astype(np.uint32), (starts - w.bounds[row]).astype(np.uint32))):
                out.append(x)
        h1, h2, row, start = map(np.concatenate, got)
        by, gone = later(h1, h2, ids[row], start)
        known, by = by[gone], by[~gone]
        out = [(block % parts, block, True, None, None, row[known].tobytes(), start[known].tobytes(), None, None)] if len(known) else []
        part = ((h1[by] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # in order, as h1 is
        for p, at in parted(part):
            mine = by[at]
            out.append((p, block, False, *(x[mine].tobytes() for x in (h1, h2, row, start)), *named(row[mine], ids)))
        return record(out, FOUND)

    def grouped(table: pa.Table) -> pa.Table:
        known = table.column("known")
        passed = table.filter(known).select(["block", "row", "start"])
        windows = table.filter(pc.invert(known))
        block, row, doc = placed(windows)
        h1, h2, start = joined(windows, "h1", np.uint64), joined(windows, "h2", np.uint64), joined(windows, "start", np.uint32)
        by, gone = later(h1, h2, doc, start)
        gone = by[gone]
        return pa.concat_tables([passed, record(list(by_block(block[gone], row[gone], start[gone])), REMOVED)])

    windows = blocks.grouped().cogroup(sketch.answers().groupBy("block")).applyInArrow(found, FOUND)
    removed = windows.groupBy("part").applyInArrow(grouped, REMOVED)
    names, at_text = blocks.names, blocks.at_text

    def cut(texts: pa.Table, gone: pa.Table) -> pa.Table:
        row, start = joined(gone, "row", np.uint32), joined(gone, "start", np.uint32)
        by = np.argsort(row, kind="stable")
        row, start = row[by], start[by].astype(np.int64)
        number = blocks.ranks(texts)[1]
        text = X.plain(texts.column(at_text))
        low, high = np.searchsorted(row, number, "left"), np.searchsorted(row, number, "right")
        kept, n_words, n_removed = [], np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        for c in X.chunks(text):
            w = X.words(c)
            cover = np.zeros(len(w.starts) + 1, np.int32)
            for i in range(c.n):
                a, b = low[c.first + i], high[c.first + i]
                if b > a:
                    at = w.bounds[i] + start[a:b]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
            keep = np.cumsum(cover[:-1]) == 0
            rows = slice(c.first, c.first + c.n)
            n_words[rows] = np.diff(w.bounds)
            count = np.append(0, np.cumsum(keep))
            n_removed[rows] = n_words[rows] - np.diff(count[w.bounds])
            kept.append(join_words(c, w, keep))
        body = pa.concat_arrays(kept) if kept else pa.array([], pa.string())
        if not rejoin:
            body = pc.if_else(pa.array(n_removed == 0), text.cast(pa.string()), body)
        if text.null_count:
            body = pc.if_else(text.is_valid(), body, pa.scalar(None, pa.string()))
        out = texts.select(list(range(len(names)))).set_column(at_text, "text", body)
        return out.append_column("n_words", pa.array(n_words)).append_column("n_removed", pa.array(n_removed))

    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return blocks.grouped().cogroup(removed.groupBy("block")).applyInArrow(cut, schema)


def join_words(c: X.Chunk, w: X.Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    n = len(c.data)
    kept = np.flatnonzero(keep)
    data, edge = c.data.copy(), np.zeros(n + 2, np.int8)
    edge[w.starts[kept]] += 1
    after = np.append(w.text[kept[1:]] == w.text[kept[:-1]], False) if len(kept) else np.empty(0, bool)
    data[w.ends[kept][after]] = 0x20
    np.add.at(edge, w.ends[kept] + after, -1)
    mask = np.cumsum(edge[:n], dtype=np.int8) > 0
    offsets = np.append(0, np.cumsum(mask))[c.offsets].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), c.n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[mask].tobytes())])
