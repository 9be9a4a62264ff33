"""Row pattern matching: a regular expression over each sequence's rows in order.

Rows are dealt by range of their order into blocks, so that one long sequence spreads over many. In a block all starts
are matched at once (patterns.py). What a block can't know alone is settled by small tables: the first row's letters, as
they may read the row before it (gates); walks that are open at a block's end, which go on over the head of the next one, the
rows that any walk may still reach there; and the path of starts. A search that enters a block at some row leaves it at
another, with a count of matches, so places of entry form chains. Pointers along these are doubled by joins until every
place that a search from a sequence's first row reaches is marked. Then blocks give away the matches on their marked paths, and a
match over several blocks is put together from its pieces.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonalyze.llm.patterns import Dfa, Rows, spelled, walk
from sonalyze.llm.shared import ship, stored
from sonalyze.llm.text import tidied

#: Rows of a block, unless there are fewer for the session's partitions.
BLOCK_ROWS = 250_000
Features = dict[str, np.ndarray]


@dataclass(frozen=True)
class Condition:
    """When a row fits a letter: fits(row, row before it, whether there is one), over arrays of the features and `value`. A row
    without a value fits no letter. at_least_first: its value must also be that of the match's first row, or more."""

    fits: Callable[[Features, Features, np.ndarray], np.ndarray]
    at_least_first: bool = False


@dataclass(frozen=True)
class Search:
    pattern: object
    letters: dict[str, Condition]
    features: tuple[str, ...]

    def dfa(self) -> Dfa:
        return Dfa(self.pattern, list(self.letters))

    @property
    def bound(self) -> int:
        return sum(1 << k for k, c in enumerate(self.letters.values()) if c.at_least_first)

    def masks(self, now: Features, before: Features, has_before: np.ndarray, valued: np.ndarray) -> np.ndarray:
        out = np.zeros(len(valued), np.int64)
        for k, c in enumerate(self.letters.values()):
            out |= (np.asarray(c.fits(now, before, has_before), bool) & valued).astype(np.int64) << k
        return out


def numbers(column: pa.Array) -> np.ndarray:
    """A feature as numbers: times in microseconds, nulls as 0."""
    if pa.types.is_timestamp(column.type):
        column = column.cast(pa.timestamp("us", column.type.tz)).view(pa.int64())
    if pa.types.is_boolean(column.type):
        column = column.cast(pa.int8())
    return column.fill_null(0).to_numpy(zero_copy_only=False)


def changes(column: pa.Array) -> np.ndarray:
    """Where a column that holds no nulls differs from the row before; the first row does."""
    return np.append(True, np.asarray(pc.not_equal(column[1:], column[:-1]), bool)) if len(column) > 1 else np.ones(len(column), bool)


def reached(starts: np.ndarray, ends: np.ndarray, limit: int) -> Callable[[int], tuple[int, int]]:
    """Where a search that is at a row leaves the rows before limit, and how many matches it has there: starts that match, in
    order, and the last rows of these."""
    keep = starts < limit
    s, after = starts[keep], (ends[keep] + 1).tolist()
    following = np.searchsorted(s, ends[keep] + 1).tolist()
    leaves = [(0, 0)] * len(s)
    for j in range(len(s) - 1, -1, -1):
        k = following[j]
        y, n = (max(after[j], limit), 0) if k == len(s) else leaves[k]
        leaves[j] = y, n + 1

    def leave(x: int) -> tuple[int, int]:
        k = int(np.searchsorted(s, x))
        return (max(x, limit), 0) if k == len(s) else leaves[k]

    return leave


def chosen(starts: np.ndarray, ends: np.ndarray, x: int, limit: int) -> list[int]:
    """Which of the matches a search from row x takes that starts before limit."""
    following = np.searchsorted(starts, ends + 1).tolist()
    k, top, out = int(np.searchsorted(starts, x)), int(np.searchsorted(starts, limit)), []
    while k < top:
        out.append(k)
        k = following[k]
    return out


def row_schema(by: pa.DataType, search: Search, types: dict[str, pa.DataType]) -> pa.Schema:
    """match: a match of a sequence within its block; run: the rows of a sequence at the block's edge, packed; row: those of these that
    walks between blocks need; edge: the block's first and last row; entry: where a search that comes in at row `at` leaves the rows that are settled in the block."""
    own = [("kind", pa.string()), ("block", pa.int32()), ("at", pa.int32()), ("key", by), ("id", pa.int64()), ("value", pa.int64()), ("mask", pa.int32()), ("to", pa.int32()), ("n", pa.int64())]
    own += [("state", pa.binary()), ("head", pa.bool_()), ("tail", pa.bool_()), ("size", pa.int32()), ("last_id", pa.int64()), ("number", pa.int64()), ("labels", pa.string()), ("packed", pa.binary())]
    return pa.schema(own + [(f"f_{f}", types[f]) for f in search.features])


def made(schema: pa.Schema, count: int, /, **columns: object) -> pa.RecordBatch:
    """count rows; columns that aren't given are null."""
    arrays = []
    for f in schema:
        x = columns.get(f.name)
        arrays.append(pa.nulls(count, f.type) if x is None else x.cast(f.type) if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) if isinstance(x, (list, np.ndarray)) else pa.array([x] * count, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def packed(ids: pa.Array, values: np.ndarray, valued: np.ndarray, masks: np.ndarray, to: np.ndarray) -> bytes:
    """Rows of one sequence as one value: ids and values with their validity, letters, and the last row of each one's match."""
    columns = (ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), values.astype(np.int64), masks.astype(np.int32), to.astype(np.int32), valued.astype(bool), np.asarray(ids.is_valid(), bool))
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpacked(held: bytes) -> list[np.ndarray]:
    n, at, out = len(held) // 26, 0, []
    for kind in (np.int64, np.int64, np.int32, np.int32, bool, bool):
        out.append(np.frombuffer(held, kind, n, at).copy())
        at += n * out[-1].itemsize
    return out


def within_blocks(search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        del held
        column = lambda name: table[name].chunk(0)
        key, ids = column("key"), column("id")
        schema = row_schema(key.type, search, {f: table[f"f_{f}"].type for f in search.features})
        block, n, dfa = TaskContext.get().partitionId(), len(table), search.dfa()
        now = {f: numbers(column(f"f_{f}")) for f in search.features}
        valued, now["value"] = np.asarray(column("value").is_valid()), numbers(column("value"))
        new = changes(key)
        bounds = np.append(np.flatnonzero(new), n)
        before = {k: np.concatenate([v[:1], v[:-1]]) for k, v in now.items()}
        rows = Rows(search.masks(now, before, ~new, valued), now["value"], np.repeat(bounds[1:], np.diff(bounds)), search.bound)
        best, state = walk(dfa, rows, np.arange(n), np.ones(n, np.int32), rows.values, np.full(n, -1))
        f, l = int(bounds[1]), int(bounds[-2])
        # the first row's own letters aren't known yet: its walk is open
        best[0], state[0] = -1, 1
        starts = np.flatnonzero(best >= 0)
        ends = best[starts]

        # sequences that lie within the block
        inner = chosen(starts, ends, f, l)
        if inner:
            s, e = starts[inner], ends[inner]
            of = np.searchsorted(bounds, s, "right")
            sums = np.append(0, np.cumsum(rows.values))
            names = [label(search, rows, a, b) for a, b in zip(s.tolist(), e.tolist())]
            number = np.arange(len(s)) - np.searchsorted(of, of) + 1
            at = pa.array(s)
            yield made(schema, len(s), kind="match", block=block, at=s, key=key.take(at), id=ids.take(at), last_id=ids.take(pa.array(e)), n=e - s + 1, value=sums[e + 1] - sums[s], number=number, labels=names)

        # rows at the edges, each with its match or open walk
        edge = np.arange(n) if l < f else np.concatenate([np.arange(f), np.arange(l, n)])
        is_open = np.zeros(n, bool)
        is_open[0] = True
        is_open[l:] |= state[l:] > 0
        first_open = np.flatnonzero(is_open[max(l, 1) :])
        limit = int(first_open[0]) + max(l, 1) if len(first_open) else n
        head = head_length(dfa, rows, f)
        kept = {int(s): pickle.dumps(dfa.states[s]) for s in np.unique(state[edge][is_open[edge]])}
        whole = column("value")
        runs = [(0, f)] if l < f else [(0, f), (l, n)]
        parts = [packed(ids.slice(a, b - a), rows.values[a:b], valued[a:b], rows.masks[a:b], best[a:b]) for a, b in runs]
        yield made(schema, len(runs), kind="run", block=block, at=[a for a, _ in runs], key=key.take(pa.array([a for a, _ in runs])), packed=parts)
        edge = edge[(edge < head) | (edge >= limit) | is_open[edge]]
        place = pa.array(edge)
        matched = best[edge] >= 0
        yield made(
            schema, len(edge), kind="row", block=block, at=edge, key=key.take(place), id=ids.take(place), value=whole.take(place), mask=rows.masks[edge], to=pa.array(best[edge], mask=~matched),
            state=[kept[int(s)] if o else None for s, o in zip(state[edge], is_open[edge])], head=edge < head, tail=edge >= limit, size=n,
        )
        ends_at = pa.array([0, n - 1])
        yield made(
            schema, 2, kind="edge", block=block, at=ends_at, key=key.take(ends_at), id=ids.take(ends_at), value=column("value").take(ends_at), head=[True, False], size=n, to=f,
            **{f"f_{x}": column(f"f_{x}").take(ends_at) for x in search.features},
        )

        # ways through the block: of the first sequence from each row that a walk may end before, of the last one from its start
        open_limit = limit if l < f else f
        leave = reached(starts[starts > 0], ends[starts > 0], open_limit)
        within = l >= f  # the first sequence ends here
        entered = [(x, *leave(x), False) for x in range(1, min(head, f - within) + 1)]
        entered = [(x, -1 if within else y, many, root) for x, y, many, root in entered]
        if within:
            entered.append((l, *reached(starts[starts >= l], ends[starts >= l], limit)(l), True))
        if not entered:
            return
        x, y, many, root = zip(*entered)
        yield made(schema, len(x), kind="entry", block=block, at=list(x), to=list(y), n=list(many), head=list(root), size=n)

    return run


def head_length(dfa: Dfa, rows: Rows, f: int) -> int:
    """How many first rows a walk that comes into the block, or that starts at its first row, may take."""
    first, states = True, dfa.all_states()
    steps: dict = {}
    for i in range(f):
        # the first row's letters aren't known yet: any may fit
        masks = range(len(dfa.sets)) if first else {int(rows.masks[i]), int(rows.masks[i]) & ~rows.bound}
        key = (states, None if first else frozenset(masks))
        if key not in steps:
            steps[key] = frozenset(t for s in states for m in masks if dfa.lives[t := dfa.step(s, m)])
        states, first = steps[key], False
        if not states:
            return i + 1
    return f


def label(search: Search, rows: Rows, a: int, b: int) -> str:
    masks, values = rows.masks[a : b + 1], rows.values[a : b + 1]
    return spelled(search.pattern, tuple(search.letters), np.where(values < values[0], masks & ~rows.bound, masks).astype(np.uint16).tobytes())


GATES = "block int, size int, length int, whole boolean, same boolean, mask int"


def gated(search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block: whether its first row goes on with the sequence of the block before, and that row's letters."""
        for batch in batches:
            of = lambda p: {f: numbers(batch.column(f"{p}_{f}")) for f in [*search.features, "value"]}
            same = np.asarray(batch.column("same"), bool)
            masks = search.masks(of("a"), of("b"), same, np.asarray(batch.column("a_value").is_valid()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "size", "f", "whole", "same")), pa.array(masks.astype(np.int32))], ["block", "size", "length", "whole", "same", "mask"])

    return run


WALKS = "origin int, at int, block int, first long, state binary, best_block int, best_at int, open boolean"


def gone_on(search: Search) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Walks of one block over the head of another."""
        is_head = np.asarray(pc.is_null(table["first"]))
        heads, walks = table.filter(pa.array(is_head)).sort_by("row"), table.filter(pa.array(~is_head))
        dfa, n = search.dfa(), len(heads)
        valued = np.asarray(heads["value"].is_valid()) if n else np.zeros(0, bool)
        masks = np.where(valued, heads["mask"].to_numpy(), 0)
        rows = Rows(masks.astype(np.int64), heads["value"].fill_null(0).to_numpy(), np.full(n, n), search.bound)
        states = np.array([dfa.known(pickle.loads(s)) for s in walks["state"].to_pylist()], np.int32)
        best, state = walk(dfa, rows, np.zeros(len(walks), np.int64), states, walks["first"].to_numpy(), np.full(len(walks), -1))
        whole = walks["whole"].to_numpy(zero_copy_only=False).astype(bool)
        goes = (state > 0) & whole
        block, found = walks["block"].to_numpy(), best >= 0
        pick = lambda new, name: pa.array([int(a) if f else b for a, f, b in zip(new, found, walks[name].to_pylist())], pa.int32())
        columns = [walks["origin"], walks["at"], pa.array((block + 1).astype(np.int32)), walks["first"], pa.array([pickle.dumps(dfa.states[s]) if g else None for s, g in zip(state, goes)], pa.binary()), pick(block, "best_block"), pick(best, "best_at"), pa.array(goes)]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["origin", "at", "block", "first", "state", "best_block", "best_at", "open"])

    return run


def ways_through(table: pa.Table) -> pa.Table:
    """Of one block: for each place of entry where its search leaves for a later block (to_block null: the sequence ends), and
    the matches that start on the way."""
    rows = table.to_pylist()
    block, size = rows[0]["block"], max(r["size"] or 0 for r in rows)
    ended = {r["at"]: (r["best_block"], r["best_at"]) for r in rows if r["kind"] == "walk"}
    tail = {r["at"]: r["to"] for r in rows if r["kind"] == "row" and r["tail"]}
    leaves: dict[int, tuple] = {size: (block + 1, 0, 0)}
    for y in sorted(tail, reverse=True):
        to_block, to = ended.get(y, (block, tail[y])) if y in ended else (block, tail[y])
        if to is None:
            leaves[y] = leaves[y + 1]
        elif to_block != block:
            leaves[y] = (to_block, to + 1, 1)
        else:
            far = leaves[to + 1]
            leaves[y] = (far[0], far[1], far[2] + 1)
    entries = {r["at"]: (r["to"], r["n"]) for r in rows if r["kind"] == "entry" and not r["head"]}
    roots = {r["at"]: (r["to"], r["n"]) for r in rows if r["kind"] == "entry" and r["head"]}

    def far_from(x: int, known: dict = entries) -> tuple:
        y, n = known.get(x, (-1, 0))
        if y < 0:  # the sequence ends
            return None, None, n
        to_block, to, more = leaves[y]
        return to_block, to, n + more

    out = [(x, *far_from(x), False) for x in entries] + [(x, *far_from(x, roots), True) for x in roots]
    to_block, to = ended.get(0, (None, None))
    if to is None:
        out.append((0, *far_from(1), False))
    elif to_block != block:
        out.append((0, to_block, to + 1, 1, False))
    else:
        far = far_from(to + 1)
        out.append((0, far[0], far[1], far[2] + 1, False))
    x, to_block, to, n, root = zip(*out)
    return pa.table([pa.array([block] * len(x), pa.int32()), pa.array(x, pa.int32()), pa.array(to_block, pa.int32()), pa.array(to, pa.int32()), pa.array(n, pa.int64()), pa.array(root, pa.bool_())], ["block", "at", "to_block", "to", "n", "root"])


def piece_schema(key: pa.DataType) -> pa.Schema:
    return pa.schema([("key", key), ("number", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n", pa.int64()), ("value", pa.int64()), ("labels", pa.string()), ("block", pa.int32()), ("at", pa.int32()), ("first", pa.int64()), ("to_block", pa.int32()), ("to", pa.int32()), ("masks", pa.binary())])


def on_paths(search: Search) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Of one block: the matches on its marked paths; those that leave it, with what they have here."""
        kind = table["kind"].combine_chunks()
        runs = sorted(table.filter(pc.equal(kind, "run")).select(["at", "key", "packed", "block"]).to_pylist(), key=lambda r: r["at"])
        entries = table.filter(pc.equal(kind, "entry")).select(["at", "n"]).to_pylist()
        ended = {r["at"]: (r["best_block"], r["best_at"]) for r in table.filter(pc.equal(kind, "walk")).select(["at", "best_block", "best_at"]).to_pylist()}
        schema = piece_schema(table["key"].type)
        if not runs or not entries:
            return schema.empty_table()
        block, keys = runs[0]["block"], [r["key"] for r in runs]
        ids, values, mask, to, valued, named = (np.concatenate(c) for c in zip(*(unpacked(r["packed"]) for r in runs)))
        mask, to = mask.astype(np.int64), to.astype(np.int64)
        sizes = [len(r["packed"]) // 26 for r in runs]
        at = np.concatenate([np.arange(n) + r["at"] for n, r in zip(sizes, runs)])
        mask[at == 0] = table.filter(pc.equal(kind, "gate"))["mask"][0].as_py()
        to_block = np.full(len(at), block)
        for a, (b, e) in ended.items():
            i = int(np.searchsorted(at, a))
            to_block[i], to[i] = (block, -1) if e is None else (b, e)
        stops = np.cumsum(sizes)
        own = Rows(mask, values, np.zeros(0), search.bound)
        sums = np.append(0, np.cumsum(np.where(valued, values, 0)))
        name = lambda i: int(ids[i]) if named[i] else None
        starts = np.flatnonzero(to >= 0)
        out: list[tuple] = []
        for e in entries:
            i = int(np.searchsorted(at, e["at"]))
            if i == len(at) or at[i] != e["at"]:
                continue
            run = int(np.searchsorted(stops, i, "right"))
            stop, number = int(stops[run]), e["n"]
            while True:
                k = int(np.searchsorted(starts, i))
                if k == len(starts) or starts[k] >= stop:
                    break
                s, number = int(starts[k]), number + 1
                there = int(to_block[s])
                last = int(to[s]) - int(at[s]) + s if there == block else stop - 1
                masks = np.where(values[s : last + 1] < values[s], mask[s : last + 1] & ~own.bound, mask[s : last + 1]).astype(np.uint16).tobytes()
                inside = there == block
                out.append((
                    keys[run], number, name(s), name(last) if inside else None, last - s + 1, int(sums[last + 1] - sums[s]), spelled(search.pattern, tuple(search.letters), masks) if inside else None,
                    block, int(at[s]), int(values[s]), there, int(to[s]), None if inside else masks,
                ))
                if not inside:
                    break
                i = last + 1
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else schema.empty_table()

    return run


def put_together(search: Search) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """One match of several blocks: its first piece, and the rows of later blocks."""
        piece = table.filter(pc.is_valid(table["number"])).to_pylist()[0]
        rows = table.filter(pc.is_null(table["number"])).sort_by([("row_block", "ascending"), ("row_at", "ascending")])
        values, mask = rows["value"].to_numpy(), rows["mask"].to_numpy().astype(np.int64)
        masks = np.where(values < piece["first"], mask & ~search.bound, mask).astype(np.uint16).tobytes()
        last = rows["last_id"][len(rows) - 1].as_py()
        out = [piece["key"], piece["number"], piece["first_id"], last, piece["n"] + len(rows), piece["value"] + int(values.sum()), spelled(search.pattern, tuple(search.letters), piece["masks"] + masks)]
        names = ["key", "number", "first_id", "last_id", "n", "value", "labels"]
        return pa.Table.from_arrays([pa.array([v], table.schema.field(x).type) for v, x in zip(out, names)], names)

    return run


def match_rows(rows: DataFrame, by: str, order: list[str], row_id: str, value: Column, features: dict[str, Column], letters: dict[str, Condition], pattern: object) -> DataFrame:
    """by, match_no, first_id, last_id, n_rows, sum_value, labels: the matches of `pattern` in each sequence of rows that are alike
    in `by`, ordered by `order`. Search starts at the first row; after a match it goes on at the row behind the match's
    last one, else one row on.

    Rows that are alike in all columns are one. Those with a null in `by` or the first of `order` are left out; other nulls
    come first. Rows that are alike in `order` are ordered by their value, features and a hash of all columns. row_id and value are
    whole numbers (a null value fits no letter); features are numbers, booleans or times, null as 0. Columns of rows may have any
    names. A pattern must take a row. An empty table has no matches.
    """
    spark = rows.sparkSession
    ship(spark)
    search = Search(pattern, letters, tuple(features))
    search.dfa()  # a wrong pattern is an error now
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns), F.array(*(F.col(f"`{c}`").isNull() for c in rows.columns)))
    names = [f"o{k}" for k in range(len(order))]
    own = rows.where(F.col(by).isNotNull() & F.col(order[0]).isNotNull())
    own = own.select(F.col(by).alias("key"), *(F.col(c).alias(n) for c, n in zip(order, names)), F.col(row_id).cast("long").alias("id"), value.cast("long").alias("value"), *(c.alias(f"f_{n}") for n, c in features.items()), whole.alias("hash"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BLOCK_ROWS))
    placed = own.repartitionByRange(parts, "key", *names).distinct().sortWithinPartitions("key", *names, "id", "value", *(f"f_{n}" for n in features), "hash")
    key_type = placed.schema["key"].dataType
    feature_types = ", ".join(f"f_{n} {placed.schema[f'f_{n}'].dataType.simpleString()}" for n in features)
    key = f"key {key_type.simpleString()}"
    schema = f"kind string, block int, at int, {key}, id long, value long, mask int, to int, n long, state binary, head boolean, tail boolean, size int, last_id long, number long, labels string, packed binary" + (f", {feature_types}" if features else "")
    found = stored(placed.drop("hash").mapInArrow(tidied(within_blocks(search)), schema), "row-blocks")

    edges, edge_rows, entries, runs = (found.where(F.col("kind") == k) for k in ("edge", "row", "entry", "run"))
    side = lambda p, rows: rows.select(F.col("key").alias(f"{p}_key"), F.col("value").alias(f"{p}_value"), *(F.col(f"f_{n}").alias(f"{p}_{n}") for n in features), "block", *(["size", F.col("to").alias("f")] if p == "a" else []))
    apart = side("a", edges.where("head")).join(side("b", edges.where("NOT head").withColumn("block", F.col("block") + 1)).hint("merge"), "block", "left")
    gates = stored(apart.withColumn("same", F.coalesce(F.col("a_key") == F.col("b_key"), F.lit(False))).withColumn("whole", F.col("f") == F.col("size")).mapInArrow(gated(search), GATES), "row-gates")

    # open walks, block by block
    mask = F.when(F.col("at") == 0, F.col("gate_mask")).otherwise(F.col("mask"))
    gate = gates.select("block", F.col("mask").alias("gate_mask"))
    heads = stored(edge_rows.where("head").select("block", "at", "mask", "value", "id", "key").join(gate.hint("merge"), "block").select("block", F.col("at").alias("row"), mask.alias("mask"), "value", "id"), "row-heads")
    opens = edge_rows.where("state IS NOT NULL").select(
        F.col("block").alias("origin"), "at", F.when(F.col("at") == 0, F.col("block")).otherwise(F.col("block") + 1).alias("block"), F.coalesce("value", F.lit(0)).cast("long").alias("first"), "state",
        F.when(F.col("to").isNotNull(), F.col("block")).alias("best_block"), F.col("to").alias("best_at"), F.lit(True).alias("open"),
    )
    ended = None
    while True:
        entering = opens.where("open").join(gates.select("block", "whole", "same").hint("merge"), "block", "left")
        goes = F.coalesce(F.col("same") | (F.col("origin") == F.col("block")), F.lit(False))
        into = entering.where(goes).select("block", "origin", "at", "first", "state", "best_block", "best_at", "whole", F.lit(None).cast("int").alias("row"), F.lit(None).cast("int").alias("mask"), F.lit(None).cast("long").alias("value"))
        over = heads.join(into.select("block", "origin").distinct().hint("merge"), "block").select("block", "origin", *(F.lit(None).cast(t).alias(c) for c, t in (("at", "int"), ("first", "long"), ("state", "binary"), ("best_block", "int"), ("best_at", "int"), ("whole", "boolean"))), "row", "mask", "value")
        after = into.unionByName(over).groupBy("block", "origin").applyInArrow(gone_on(search), WALKS)
        closed = entering.where(~goes).select("origin", "at", "block", "first", "state", "best_block", "best_at", F.lit(False).alias("open"))
        opens = stored(after.unionByName(closed), "row-walks")
        done = opens.where("NOT open").select("origin", "at", "best_block", "best_at")
        ended = done if ended is None else ended.unionByName(done)
        if opens.where("open").isEmpty():
            break
    walks = ended.select(F.lit("walk").alias("kind"), F.col("origin").alias("block"), "at", "best_block", "best_at")

    # where searches enter blocks, and where they go from there
    targets = ended.where("best_block > origin").select(F.col("best_block").alias("block"), (F.col("best_at") + 1).alias("at")).distinct()
    used = entries.where("at = 1 OR head").unionByName(entries.where("at > 1 AND NOT head").join(targets.hint("merge"), ["block", "at"], "left_semi").select(*entries.columns))
    inner = ended.where("at = 0 AND best_block = origin").select(F.col("origin").alias("block"), (F.col("best_at") + 1).alias("at"))
    used = used.unionByName(entries.where("at > 1 AND NOT head").join(inner.hint("merge"), ["block", "at"], "left_semi").select(*entries.columns)).distinct()
    known = used.unionByName(edge_rows.where("tail")).select("kind", "block", "at", "to", "n", "head", "tail", "size").unionByName(walks, allowMissingColumns=True)
    nodes = known.groupBy("block").applyInArrow(ways_through, "block int, at int, to_block int, to int, n long, root boolean")
    # what would go on behind a sequence's last row is its end
    same = gates.select(F.col("block").alias("to_block"), "same", "length", F.col("whole"))
    same = same.select("to_block", F.when(F.col("same"), F.when(F.col("whole"), F.col("length")).otherwise(F.col("length") - 1)).alias("most"))
    nodes = nodes.join(same.hint("merge"), "to_block", "left").join(gates.select("block", "same").hint("merge"), "block")
    nodes = stored(nodes.select("block", "at", F.when(F.col("to") <= F.col("most"), F.col("to_block")).alias("to_block"), F.when(F.col("to") <= F.col("most"), F.col("to")).alias("to"), "n", (F.col("root") | (F.col("at") == 0) & ~F.col("same")).alias("root")), "row-ways")

    # pointers doubled: after k rounds the marked places are those within 2^k steps of a sequence's first row
    marked = nodes.where("root").select("block", "at", F.lit(0).cast("long").alias("n"))
    jumps = nodes.where("to_block IS NOT NULL").select("block", "at", "to_block", "to", "n")
    while not jumps.isEmpty():
        ahead = marked.join(jumps.withColumnRenamed("n", "more").hint("merge"), ["block", "at"]).select(F.col("to_block").alias("block"), F.col("to").alias("at"), (F.col("n") + F.col("more")).alias("n"))
        marked = stored(marked.unionByName(ahead), "row-marked")
        second = jumps.select(F.col("block").alias("to_block"), F.col("at").alias("to"), F.col("to_block").alias("far_block"), F.col("to").alias("far"), F.col("n").alias("more"))
        jumps = stored(jumps.join(second.hint("merge"), ["to_block", "to"]).select("block", "at", F.col("far_block").alias("to_block"), F.col("far").alias("to"), (F.col("n") + F.col("more")).alias("n")), "row-jumps")

    paths = marked.select(F.lit("entry").alias("kind"), "block", "at", "n")
    held = runs.select("kind", "block", "at", "key", "packed").unionByName(walks, allowMissingColumns=True).unionByName(paths, allowMissingColumns=True)
    held = held.unionByName(gates.select(F.lit("gate").alias("kind"), "block", "mask"), allowMissingColumns=True)
    pieces = held.groupBy("block").applyInArrow(on_paths(search), f"{key}, number long, first_id long, last_id long, n long, value long, labels string, block int, at int, first long, to_block int, to int, masks binary")
    pieces = stored(pieces, "row-pieces")
    columns = ["key", "number", "first_id", "last_id", "n", "value", "labels"]
    long = pieces.where("to_block <> block")
    later = long.select(F.col("block").alias("of"), F.col("at").alias("of_at"), "to_block", "to", F.explode(F.expr("sequence(block + 1, to_block)")).alias("block"))
    later = later.join(heads.hint("merge"), "block").where("block < to_block OR row <= to").select("of", "of_at", F.col("block").alias("row_block"), F.col("row").alias("row_at"), F.coalesce("value", F.lit(0)).cast("long").alias("value"), "mask", F.col("id").alias("last_id"))
    parted = long.withColumnsRenamed({"block": "of", "at": "of_at"}).drop("to_block", "to", "last_id").unionByName(later, allowMissingColumns=True)
    joined = parted.groupBy("of", "of_at").applyInArrow(put_together(search), f"{key}, number long, first_id long, last_id long, n long, value long, labels string")
    matches = found.where("kind = 'match'").select("key", "number", F.col("id").alias("first_id"), "last_id", "n", "value", "labels")
    matches = matches.unionByName(pieces.where("to_block = block").select(*columns)).unionByName(joined.select(*columns))
    return matches.select(F.col("key").alias(by), F.col("number").alias("match_no"), "first_id", "last_id", F.col("n").alias("n_rows"), F.col("value").alias("sum_value"), "labels")
