"""Language-model scores by a probabilistic suffix tree over words.

A symbol is a word, or the end of a text, which also stands before it. A context of k symbols is a state if its
suffix of k - 1 symbols is one (the empty one always is), if it occurs often enough in training, and if its next
symbols diverge from those of its suffix: their likelihood under their own frequencies (of its cells, and of all
others together) must gain enough over that under the suffix's frequencies. Next symbols that occur often enough
are cells, with a mass of their own by absolute discounting; the rest is left to the suffix, down to the
add-constant distribution of words, so every state sums to one. Each token is scored in its longest suffix state.
All bounds are counts, none a share of the corpus: the tree grows with it (Bounds).

Nothing is broadcast. Texts are in blocks, which are read four times:
1. words are counted exactly, and runs of two and three symbols sketched, by range of cells;
2. runs that may be frequent are counted exactly, longer ones where all runs of three in them may be frequent;
3. the counts of a run, of its beginning and of its end give each token's gain in each context; a block sums them
   by context, and parts dealt by context sum over blocks: a frequent context is a row a block;
4. texts are scored with the states, counts and words that their block was told of.

What is asked is sent in ascending order of its hashes, as gaps. A block finds what it asked again from its texts and
from marks of the tokens that the sketches left, so answers are a bit for each hash in that order, and the numbers of
those that have the bit: no hash comes back.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonalyze.llm import text as X
from sonalyze.llm.shared import discard, n_buckets, stored
from sonalyze.llm.sketch import ASKED, Blocks, Places, Sketch, text_bytes

DISCOUNT, ADDED = 0.75, 0.1
#: Bytes of text that a block, and a part of words, runs or contexts, are made for.
BLOCK_BYTES, PART_BYTES = 6 << 20, 16 << 20
END = np.uint64(0x5851F42D4C957F2D)
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, state_share double"
#: What a block is told, by kind and by part (range), in the order in which the block asked it: counts of its words
#: (c2); which of its runs are cells, and their counts; which of its contexts are states, and their cells' tokens and
#: cells. MARKS are its own, of the tokens that end a run of two (c1) or of three (c2) that may be a cell.
TOLD = "block int, kind int, range long, c1 binary, c2 binary"
SKETCH, WORDS, RUNS, STATES, MARKS = range(5)
SENT = "part int, block int, value binary, n binary"
#: Contexts: occurrences; over the tokens behind them in a block that are cells: how many, and sums of one by the
#: cell's count, of the token's gain, and of the suffix's frequency by the cell's count.
SUMS = "part int, block int, context binary, total binary, n binary, cells binary, gain binary, p binary"


@dataclass(frozen=True)
class Bounds:
    """Occurrences of a state, and of a next symbol with a mass of its own; nats that a state must gain over its
    suffix; symbols of the longest context."""

    state: int = 64
    cell: int = 8
    gain: float = 20.0
    depth: int = 5


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def rows_of(schema: str, rows: list[tuple]) -> pa.Table:
    kinds, words = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}, schema.replace(",", "").split()
    columns = list(zip(*rows)) if rows else [[]] * (len(words) // 2)
    return pa.table([pa.array(c, kinds[k]) for c, k in zip(columns, words[1::2], strict=True)], words[::2])


def joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in table.column(name) if x.is_valid), kind)


def counts_of(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(from_planes(x.as_py()) for x in table.column(name))])


def hashes_of(table: pa.Table, name: str) -> list[np.ndarray]:
    """Of each row."""
    return [from_gaps(x.as_py()) for x in table.column(name)]


def summed(key: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys, sorted, and sums of the weights of each."""
    by = np.argsort(key)
    edges = X.group_starts(key[by])[:-1]
    return key[by[edges]], *(np.add.reduceat(w[by], edges) if len(key) else w for w in weights)


def parted(value: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """The parts that ascending hashes are dealt to, by their upper bits, and where each part's are."""
    part = ((value >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    edges = X.group_starts(part).tolist()
    return [(int(part[a]), slice(a, b)) for a, b in zip(edges[:-1], edges[1:])]


def squeezed(blob: bytes) -> bytes:
    return len(blob).to_bytes(8, "little") + pa.compress(blob, "zstd", asbytes=True)


def restored(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], size, "zstd", asbytes=True) if size else b""


def planes(n: np.ndarray) -> bytes:
    """Counts byte by byte, as many bytes as the largest takes: the higher ones are mostly zeros, which cost nothing."""
    width = max(1, -(-int(n.max(initial=0)).bit_length() // 8))
    return bytes([width]) + squeezed(n.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def from_planes(blob: bytes) -> np.ndarray:
    low = np.frombuffer(restored(blob[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((low.shape[1], 8), np.uint8)
    out[:, : blob[0]] = low.T
    return out.view("<i8").ravel()


def gaps(value: np.ndarray) -> bytes:
    """Ascending hashes."""
    return planes(np.diff(value, prepend=np.uint64(0)))


def from_gaps(blob: bytes) -> np.ndarray:
    return np.cumsum(from_planes(blob).view(np.uint64), dtype=np.uint64)


def bits(x: np.ndarray) -> bytes:
    return squeezed(np.packbits(x).tobytes())


def from_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(restored(blob), np.uint8), count=n).astype(bool)


class Symbols:
    """The symbols of a block's rows: s has the end first, then each text's words and its end; of all but the first,
    the row and the place in it, and whether it is of training."""

    def __init__(self, table: pa.Table):
        X.trim()
        s, row, place = [np.array([END])], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        for c in X.chunks(table.column(1)):
            w = X.words(c, lower=True)
            own, sizes = np.full(len(w.codes) + c.n, END), np.diff(w.bounds) + 1
            own[np.arange(len(w.codes)) + w.text] = w.codes
            s.append(own)
            row.append(np.repeat(np.arange(c.first, c.first + c.n, dtype=np.int32), sizes))
            place.append((np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32))
        self.s, self.row, self.place = map(np.concatenate, (s, row, place))
        self.training = np.array([not held_out(k) for k in table.column(0).to_pylist()], bool)
        self.train = self.training[self.row]
        self.sums = X.prefix(self.s, X.BASE_WORD)
        self.inverse = X.inverse_powers(X.BASE_WORD, len(self.sums))

    def __len__(self) -> int:
        return len(self.row)

    def runs(self, n: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the n symbols up to and with each token; one symbol is its own hash."""
        if n == 1:
            return self.s[at + 1]
        begin = at + 2 - n
        return X.mix((self.sums[at + 2] - self.sums[begin]) * self.inverse[begin] + np.uint64(n))

    def whole(self, n: int) -> np.ndarray:
        """The tokens before which there are n - 1 symbols of their text, the end before it among them."""
        return np.flatnonzero(self.place >= n - 2)


def in_a_row(at: np.ndarray, size: int) -> np.ndarray:
    """How many of the marked tokens stand in a row up to each token."""
    marked = np.zeros(size, bool)
    marked[at] = True
    place = np.arange(size)
    return place - np.maximum.accumulate(np.where(marked, -1, place))


class Runs:
    """The runs of a block that it asks about, in ascending order (value); by length, the tokens that end one (at), and
    which it is (place). marks: of the tokens that end a run of two, and of three, those whose run may be frequent. Of
    a longer run, all runs of three may be frequent."""

    def __init__(self, own: Symbols, marks: list[np.ndarray], depth: int):
        self.at, found, marked = {}, [np.empty(0, np.uint64)], None
        for n in range(2, depth + 2):
            at = own.whole(n)
            at = at[marks[n - 2]] if n < 4 else at[marked[at] >= n - 2]
            if n == 3:
                marked = in_a_row(at, len(own))
            self.at[n] = at
            found.append(own.runs(n, at))
        found = np.concatenate(found)
        by = np.argsort(found)
        edges = X.group_starts(found[by])
        self.value = found[by[edges[:-1]]]
        place = np.empty(len(found), np.int32)
        place[by] = np.repeat(np.arange(len(edges) - 1, dtype=np.int32), np.diff(edges))
        self.place = dict(zip(self.at, np.split(place, np.cumsum([len(x) for x in self.at.values()])[:-1])))


class Learner:
    """The passes over the texts; what workers run needs no table."""

    def __init__(self, docs: DataFrame, bounds: Bounds):
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        size, self.bounds = text_bytes(docs), bounds
        self.blocks, self.parts = Blocks(docs, size, BLOCK_BYTES), n_buckets(docs.sparkSession, size, PART_BYTES)
        # about a word in six bytes; words of held-out texts are asked about
        self.sketch = Sketch(self.blocks, None, 2 * size // 6, least=bounds.cell.bit_length() - 1)
        self.told: dict[int, DataFrame] = {}
        self.tokens = self.words = 0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("told", "first")}

    def ordered(self, table: pa.Table) -> pa.Table:
        """A block's rows by id and text: they come in another order whenever the block is put together."""
        return table.take(pa.array(np.lexsort((table.column(len(self.blocks.names)).to_numpy(), X.ids(table.column(0))))))

    def with_answers(self, *kinds: int):
        """The blocks with what they were told of these kinds."""
        out = self.told[kinds[0]]
        for k in kinds[1:]:
            out = out.unionByName(self.told[k])
        return self.blocks.grouped().cogroup(out.groupBy("block"))

    def sketch_words(self) -> None:
        def ask(key: tuple, table: pa.Table) -> pa.Table:
            own, block = Symbols(table), key[0].as_py()
            code, n = summed(own.s[1:], own.train.astype(np.int64))
            out = [(-1 - p, block, gaps(code[at]), planes(n[at])) for p, at in parted(code, self.parts)]
            at = [own.whole(n) for n in (2, 3)[: self.bounds.depth]]
            keys = [own.runs(n, t) for n, t in zip((2, 3), at)]
            words = pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ASKED.replace(",", "").split()[::2])
            return pa.concat_tables([words, self.sketch.ask(block, np.concatenate(keys), np.concatenate([own.train[t] for t in at]))])

        def answer(key: tuple, table: pa.Table) -> pa.Table:
            part = key[0].as_py()
            if part >= 0:
                return told(self.sketch.answer(part, table))
            sent = hashes_of(table, "cells")
            code, n = summed(np.concatenate(sent), counts_of(table, "times"))
            out = [(-1, WORDS, int(n.sum()), None, None), (-2, WORDS, int((n > 0).sum()), None, None)]
            for block, own in zip(table.column("block").to_pylist(), sent):
                out.append((block, WORDS, -1 - part, None, planes(n[np.searchsorted(code, own)])))
            return rows_of(TOLD, out)

        both = self.first = stored(self.blocks.grouped().applyInArrow(ask, ASKED).groupBy("range").applyInArrow(answer, TOLD), "tree-words")
        sums = {r["block"]: r["n"] for r in both.where("block < 0").groupBy("block").agg(F.sum("range").alias("n")).collect()}
        self.tokens, self.words = sums.get(-1, 0), sums.get(-2, 0)
        self.told |= {k: both.where((F.col("block") >= 0) & (F.col("kind") == k)) for k in (SKETCH, WORDS)}

    def marks(self, own: Symbols, answers: pa.Table) -> list[np.ndarray]:
        """Of the tokens that end a run of two, and of three, those whose run may be frequent."""
        heard = self.sketch.heard(sketched(answers))
        return [heard.level(own.runs(n, own.whole(n))) >= self.bounds.cell.bit_length() - 1 for n in (2, 3)[: self.bounds.depth]]

    def runs(self, own: Symbols, answers: pa.Table) -> Runs:
        """The runs that this block asked about."""
        held = next(of_kind(answers, MARKS, "c1", "c2"))
        return Runs(own, [from_bits(held[n - 2].as_py(), len(own.whole(n))) for n in (2, 3)[: self.bounds.depth]], self.bounds.depth)

    def count_runs(self) -> None:
        def ask(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
            own, block = Symbols(self.ordered(table)), key[0].as_py()
            marks = self.marks(own, answers)
            runs = Runs(own, marks, self.bounds.depth)
            n = np.zeros(len(runs.value))
            for k, at in runs.at.items():
                n += np.bincount(runs.place[k], own.train[at], len(n))
            out = [(p, block, gaps(runs.value[at]), planes(n[at])) for p, at in parted(runs.value, self.parts)]
            return rows_of(SENT, [*out, (-1 - block, block, *([bits(x) for x in marks] + [None])[:2])])

        def answer(key: tuple, table: pa.Table) -> pa.Table:
            part, blocks = key[0].as_py(), table.column("block").to_pylist()
            if part < 0:
                return rows_of(TOLD, [(blocks[0], MARKS, 0, table.column("value")[0].as_py(), table.column("n")[0].as_py())])
            sent, out = hashes_of(table, "value"), []
            runs, n = summed(np.concatenate(sent), counts_of(table, "n"))
            for block, own in zip(blocks, sent):
                mine = n[np.searchsorted(runs, own)]
                often = mine >= self.bounds.cell
                out.append((block, RUNS, part, bits(often), planes(mine[often])))
            return rows_of(TOLD, out)

        self.told[RUNS] = stored(self.with_answers(SKETCH).applyInArrow(ask, SENT).groupBy("part").applyInArrow(answer, TOLD), "tree-runs")
        self.told[WORDS] = stored(self.told[WORDS], "tree-counts")
        discard(self.first)

    def choose_states(self) -> None:
        def ask(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
            own = Symbols(self.ordered(table))
            counts = Counts(own, answers, self)
            got = np.zeros((4, len(counts.code) + len(counts.runs.value)))
            for k, at, context, total, n in counts.contexts():
                cell = np.flatnonzero((n > 0) & own.train[at])
                context, total, times, p = context[cell], total[cell], n[cell], counts.frequency(k, at[cell])
                for g, x in zip(got, (None, 1 / times, np.log(times / (total * p)), p / times)):
                    g += np.bincount(context, x, len(g))
                del at, context, total, n, cell, times, p
            which = counts.candidates()
            context, total, n, (cells, gain, p) = counts.hashes(which), counts.occurrences(which), got[0, which], got[1:, which]
            return rows_of(SUMS, [(part, key[0].as_py(), gaps(context[at]), planes(total[at]), planes(n[at]), *(x[at].astype("<f4").tobytes() for x in (cells, gain, p))) for part, at in parted(context, self.parts)])

        def answer(key: tuple, table: pa.Table) -> pa.Table:
            each = hashes_of(table, "context")
            sent = np.concatenate(each)
            total, n = (counts_of(table, c).astype(np.float64) for c in ("total", "n"))
            cells, gain, p = (joined(table, c, np.float32).astype(np.float64) for c in ("cells", "gain", "p"))
            by = np.argsort(sent, kind="stable")
            edges = X.group_starts(sent[by])[:-1]
            context, total = sent[by[edges]], total[by[edges]]
            n, cells, gain, p = (np.add.reduceat(x[by], edges) if len(by) else x for x in (n, cells, gain, p))
            rest = np.maximum(total - n, 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                others = np.where(rest > 0, rest * np.log(rest / (total * np.maximum(1 - p, 1e-9))), 0)
            good = gain + others >= self.bounds.gain
            n, cells, out = n.astype(np.int64), np.round(cells).astype(np.int64), []
            for block, own in zip(table.column("block").to_pylist(), each):
                at = np.searchsorted(context, own)
                state = good[at]
                at = at[state]
                out.append((block, STATES, key[0].as_py(), bits(state), planes(np.concatenate([n[at], cells[at]]))))
            return rows_of(TOLD, out)

        self.told[STATES] = stored(self.with_answers(WORDS, RUNS).applyInArrow(ask, SUMS).groupBy("part").applyInArrow(answer, TOLD), "tree-states")


def told(answers: pa.Table) -> pa.Table:
    columns = [answers.column("block"), pa.array([SKETCH] * len(answers), pa.int32()), answers.column("range"), answers.column("cells"), answers.column("level")]
    return pa.table(columns, TOLD.replace(",", "").split()[::2])


def sketched(answers: pa.Table) -> pa.Table:
    own = answers.filter(pa.array(answers.column("kind").to_numpy() == SKETCH))
    return pa.table([own.column("range"), own.column("c1"), own.column("c2")], ["range", "cells", "level"])


def of_kind(answers: pa.Table, kind: int, *columns: str):
    own = answers.filter(pa.array(answers.column("kind").to_numpy() == kind))
    return zip(*(own.column(c) for c in columns))


class Counts:
    """Training counts of the words and runs that end at each token of a block. A context is known by its place: among
    the block's words if it is one symbol, and behind these, among its runs."""

    def __init__(self, own: Symbols, answers: pa.Table, learner: Learner):
        self.own, self.bounds, self.tokens, self.words, self.parts = own, learner.bounds, learner.tokens, learner.words, learner.parts
        self.code = code = np.unique(own.s[1:])
        index = Places(code).of(own.s[1:])
        self.count = counts = np.zeros(len(code), np.int64)
        places = dict(parted(code, self.parts))
        for part, n in of_kind(answers, WORDS, "range", "c2"):
            counts[places[part.as_py()]] = from_planes(n.as_py())
        self.index = np.append(np.searchsorted(code, END), index)
        self.all = np.append(counts[self.index[0]] if len(code) else 0, counts[index])
        self.n = [self.all[1:]]
        self.runs = runs = learner.runs(own, answers)
        self.often = counts = np.zeros(len(runs.value), np.int64)
        places = dict(parted(runs.value, self.parts))
        for part, which, n in of_kind(answers, RUNS, "range", "c1", "c2"):
            at = places[part.as_py()]
            counts[at][from_bits(which.as_py(), at.stop - at.start)] = from_planes(n.as_py())
        for k, at in runs.at.items():
            n = np.zeros(len(own), np.int64)
            n[at] = counts[runs.place[k]]
            self.n.append(n)

    def base(self) -> np.ndarray:
        return (self.n[0] + ADDED) / (self.tokens + ADDED * (self.words + 1))

    def total(self, k: int, at: np.ndarray) -> np.ndarray:
        """Of the k symbols before each token."""
        return self.all[at] if k == 1 else self.n[k - 1][at - 1]

    def contexts(self):
        """For each length: the tokens whose context may be a state, the context's place, its count, and that of the cell."""
        for k in range(1, self.bounds.depth + 1):
            at = self.own.whole(k + 1)
            total = self.total(k, at)
            often = total >= self.bounds.state
            at, total = at[often], total[often]
            if k == 1:
                place = self.index[at]
            else:
                run = np.zeros(len(self.own), np.int32)
                run[self.runs.at[k]] = self.runs.place[k]
                place = run[at - 1] + len(self.code)
            yield k, at, place, total, self.n[k][at]

    def candidates(self) -> np.ndarray:
        """The places of the block's contexts that may be states, in the order in which it asks about them."""
        may = np.append(self.count >= self.bounds.state, np.zeros(len(self.runs.value), bool))
        for _, _, place, _, _ in self.contexts():
            may[place] = True
        which = np.flatnonzero(may)
        return which[np.argsort(self.hashes(which), kind="stable")]

    def hashes(self, which: np.ndarray) -> np.ndarray:
        return np.append(self.code, self.runs.value)[which]

    def occurrences(self, which: np.ndarray) -> np.ndarray:
        return np.append(self.count, self.often)[which]

    def left(self, answers: pa.Table) -> np.ndarray:
        """By place: what the cells of a state leave to its suffix; -1 where there is no state."""
        which = self.candidates()
        places, out = dict(parted(self.hashes(which), self.parts)), np.full(len(self.code) + len(self.runs.value), -1.0)
        for part, state, sums in of_kind(answers, STATES, "range", "c1", "c2"):
            own = which[places[part.as_py()]]
            own = own[from_bits(state.as_py(), len(own))]
            n, cells = from_planes(sums.as_py()).reshape(2, -1)
            out[own] = 1 - (n - DISCOUNT * cells) / np.maximum(self.occurrences(own), 1)
        return out

    def frequency(self, k: int, at: np.ndarray) -> np.ndarray:
        """Of each token behind the suffix of its context of k symbols; where it is a cell of the context."""
        return self.n[k - 1][at] / (self.tokens if k == 1 else np.maximum(self.total(k - 1, at), 1))


def learn(docs: DataFrame, bounds: Bounds) -> Learner:
    learner = Learner(docs, bounds)
    learner.sketch_words()
    learner.count_runs()
    learner.choose_states()
    return learner


def score(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """A row for each document with its log10 probability under the tree (score) and under the words'
    add-constant distribution (base_score).

    docs has doc_id and text; other columns are not read. Documents whose crc32(doc_id as text) mod 10 is 0
    are held out of training; a null doc_id counts as ''. Tokens are lower-cased (A-Z) words, then one end.
    Null and empty texts are the end alone. Repeated rows are scored and counted each. state_share is the
    part of the tokens that a state of one symbol or more scored. An empty table gives no rows.
    """
    learner = learn(docs, bounds)

    def scored(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = learner.ordered(table)
        own, rows = Symbols(table), table.num_rows
        counts = Counts(own, answers, learner)
        left = counts.left(answers)
        base = counts.base()
        p, depth = base.copy(), np.zeros(len(own), np.int64)
        for k, at, context, total, n in counts.contexts():
            behind = depth[at] == k - 1  # a state
            behind[behind] = left[context[behind]] >= 0
            at, context, total, n = at[behind], context[behind], total[behind], n[behind]
            p[at] = p[at] * left[context] + np.where(n > 0, (n - DISCOUNT) / total, 0)
            depth[at] = k
        each = lambda x: np.bincount(own.row, x, rows)
        n_tokens = np.bincount(own.row, minlength=rows)
        return pa.table({"doc_id": table.column(0), "held_out": pa.array(~own.training), "n_tokens": n_tokens, "n_known": each(counts.n[0] > 0).astype(np.int64), "train_tokens": np.full(rows, learner.tokens), "base_score": each(np.log10(base)), "score": each(np.log10(p)), "state_share": each(depth > 0) / np.maximum(n_tokens, 1)})

    return learner.with_answers(WORDS, RUNS, STATES).applyInArrow(scored, SCORES)
