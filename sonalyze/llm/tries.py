"""Radix tries over the bytes of terms, whose leaves count by group.

A trie is held in preorder, which is the UTF-8 order of its terms: a leaf has the depth of the node where its path leaves
that of the leaf before it, and the label from there on. Subtries below a prefix travel as rows of their own, and tries
merge by walking equal prefixes side by side.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sonalyze.llm.text import group_starts

#: Bytes of the prefix below which a subtrie is one row.
PREFIX = 4
SUBTRIES = pa.schema([("prefix", pa.binary()), ("labels", pa.binary()), ("shape", pa.binary()), ("counters", pa.binary())])
#: A subtrie's leaves: shared depth, length of the label, number of counters; a counter: lang, group, occurrences, documents.
SHAPE, COUNTER = 3, 4


def folded(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(key, kind="stable")
    at = group_starts(key[order])[:-1]
    return key[order][at], *(np.add.reduceat(v[order], at) if len(at) else v for v in values)


def shared_depths(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes each term begins with that the term before it begins with too; 0 for the first."""
    n = len(offsets) - 1
    out = np.zeros(n, np.int64)
    live, length = np.arange(1, n), np.diff(offsets)
    depth = 0
    while len(live):
        live = live[(length[live] > depth) & (length[live - 1] > depth)]
        live = live[data[offsets[live] + depth] == data[offsets[live - 1] + depth]]
        depth += 1
        out[live] = depth
    return out


@dataclass
class Trie:
    """terms: the leaves' paths in UTF-8 order; leaf, lang, group, n, docs: counters, by leaf."""

    terms: pa.Array
    leaf: np.ndarray
    lang: np.ndarray
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray

    def __len__(self) -> int:
        return len(self.terms)

    @staticmethod
    def counted(tokens: pa.Array, doc: np.ndarray, lang: np.ndarray, group: np.ndarray) -> Trie:
        """The trie of tokens: doc is each token's document, lang and group those of each document."""
        coded = tokens.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        width = max(len(lang), 1)
        pair, n = folded(code * width + doc, np.ones(len(code), np.int64))  # (term, document)
        of = pair % width
        return Trie(coded.dictionary, pair // width, lang[of], group[of], n, np.ones(len(pair), np.int64)).tidy()

    @staticmethod
    def merged(tries: list[Trie]) -> Trie:
        """One trie of the leaves of all, with the sums of their counters."""
        firsts = np.cumsum([0, *map(len, tries)])
        both = lambda name: np.concatenate([getattr(t, name) for t in tries])
        terms = pa.concat_arrays([t.terms for t in tries])
        leaf = np.concatenate([t.leaf + f for t, f in zip(tries, firsts)])
        coded = terms.dictionary_encode()
        return Trie(coded.dictionary, np.asarray(coded.indices).astype(np.int64)[leaf], both("lang"), both("group"), both("n"), both("docs")).tidy()

    def tidy(self) -> Trie:
        """Leaves in order, and one counter a leaf and group."""
        order = np.asarray(pc.sort_indices(self.terms)).astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        known, group = np.unique(self.group, return_inverse=True)
        key, n, docs = folded(rank[self.leaf] * max(len(known), 1) + group, self.n, self.docs)
        lang = np.zeros(len(known), np.int64)
        lang[group] = self.lang
        own = key % max(len(known), 1)
        return Trie(self.terms.take(pa.array(order)), key // max(len(known), 1), lang[own], known[own], n, docs)

    def subtries(self) -> pa.RecordBatch:
        """A row for each prefix of PREFIX bytes, or term that is shorter: labels and depths within it."""
        body, offsets = _bytes(self.terms)
        length = np.diff(offsets)
        depth = shared_depths(body, offsets)
        new = (depth < PREFIX) & ~((depth == length) & (length < PREFIX))
        new[1:] |= np.minimum(length[:-1], PREFIX) != np.minimum(length[1:], PREFIX)
        first = np.flatnonzero(new)
        top = np.minimum(length, PREFIX)
        depth = np.where(new, top, depth)
        label = length - depth
        keep = np.repeat(offsets[:-1] + depth - (np.cumsum(label) - label), label) + np.arange(label.sum())
        per_leaf = np.bincount(self.leaf, minlength=len(self))
        shape = np.stack([depth, label, per_leaf], 1).astype(np.int32)
        counters = np.stack([self.lang, self.group, self.n, self.docs], 1)
        ends = np.append(first, len(self))
        cut = lambda data, at: pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])
        heads = np.repeat(offsets[first] - (np.cumsum(top[first]) - top[first]), top[first]) + np.arange(top[first].sum())
        sums = lambda x: np.append(0, np.cumsum(x))[ends]
        columns = [cut(body[heads], np.append(0, np.cumsum(top[first]))), cut(body[keep], sums(label)), cut(shape, ends * 4 * SHAPE), cut(counters, sums(per_leaf) * 8 * COUNTER)]
        return pa.RecordBatch.from_arrays(columns, schema=SUBTRIES)

    @staticmethod
    def read(rows: pa.RecordBatch) -> Trie:
        """The leaves of rows of subtries, as they come: merged() puts them in order."""
        prefixes = rows.column("prefix").to_pylist()
        labels = _bytes(rows.column("labels"))[0].tobytes()
        shape, shape_at = _bytes(rows.column("shape"))
        shape = np.frombuffer(shape.tobytes(), np.int32).reshape(-1, SHAPE)
        counters = np.frombuffer(_bytes(rows.column("counters"))[0].tobytes(), np.int64).reshape(-1, COUNTER)
        leaves = np.diff(shape_at) // (4 * SHAPE)
        terms, at, k = [], 0, 0
        depths, lengths = shape[:, 0].tolist(), shape[:, 1].tolist()
        for prefix, many in zip(prefixes, leaves.tolist()):
            path = prefix
            for i in range(k, k + many):
                to = at + lengths[i]
                path = path[: depths[i]] + labels[at:to]
                at = to
                terms.append(path)
            k += many
        return Trie(pa.array(terms, pa.binary()), np.repeat(np.arange(len(terms)), shape[:, 2]), *counters.T)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    from sonalyze.llm.text import buffers

    return buffers(column)


def by_prefix(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[Trie]:
    """Tries of rows of subtries that come in order of their prefixes: all rows of a prefix go into one, and a trie has some
    `most` leaves before they are merged, or one prefix's."""
    held: list[pa.RecordBatch] = []
    leaves = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.diff(_bytes(batch.column("shape"))[1]) // (4 * SHAPE))
        prefix = batch.column("prefix")
        new = np.append(True, np.asarray(pc.not_equal(prefix[1:], prefix[:-1]), bool)) if batch.num_rows > 1 else np.ones(1, bool)
        if held:
            new[0] = prefix[0] != held[-1].column("prefix")[held[-1].num_rows - 1]
        done = 0
        for at in np.flatnonzero(new).tolist():
            if leaves + (size[at - 1] if at else 0) - (size[done - 1] if done else 0) >= most:
                yield Trie.merged([Trie.read(x) for x in [*held, batch.slice(done, at - done)] if x.num_rows])
                held, leaves, done = [], 0, at
        held.append(batch.slice(done))
        leaves += int(size[-1] - (size[done - 1] if done else 0))
    if held:
        yield Trie.merged([Trie.read(x) for x in held])
