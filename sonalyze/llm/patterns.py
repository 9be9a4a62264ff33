"""Regular expressions over rows, matched by symbolic derivatives.

The letters of a pattern are conditions on a row, of which several may hold, so a row is the set of letters that fit it. A
state is what may still follow: alternatives in order of preference, up to the first that needs nothing more. The derivative
of a state by a row is the next one. States and derivatives are made when a row first asks for them, and kept: a lazy DFA,
over which all starts walk side by side.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from dataclasses import dataclass
from functools import lru_cache
from math import inf

import numpy as np


@dataclass(frozen=True)
class Letter:
    name: str


@dataclass(frozen=True)
class Seq:
    parts: tuple


@dataclass(frozen=True)
class Either:
    """Alternatives, the preferred first."""

    parts: tuple


@dataclass(frozen=True)
class Many:
    """Any number of times; as few as will do, if lazy."""

    body: object
    lazy: bool = False


NOTHING = Seq(())
MOST_LETTERS = 12


def seq(*parts: object) -> object:
    flat = tuple(y for x in parts for y in (x.parts if isinstance(x, Seq) else (x,)))
    return flat[0] if len(flat) == 1 else Seq(flat)


@lru_cache(maxsize=None)
def ways(pattern: object) -> tuple:
    """How a pattern can go on, the preferred first: a letter and what follows it, or None where it needs nothing more.
    A round of Many that takes no row is none."""
    if isinstance(pattern, Letter):
        return ((pattern.name, NOTHING),)
    if isinstance(pattern, Either):
        return tuple(w for p in pattern.parts for w in ways(p))
    if isinstance(pattern, Many):
        again = tuple((w[0], seq(w[1], pattern)) for w in ways(pattern.body) if w is not None)
        return (None, *again) if pattern.lazy else (*again, None)
    if not pattern.parts:
        return (None,)
    tail = seq(*pattern.parts[1:])
    return tuple(x for w in ways(pattern.parts[0]) for x in (ways(tail) if w is None else ((w[0], seq(w[1], tail)),)))


def settled(found: list) -> tuple[tuple, bool]:
    """A state of ways: each once, none behind one that needs nothing more, and whether there is such a one."""
    out = list(dict.fromkeys(found))
    return (tuple(out[: out.index(None)]), True) if None in out else (tuple(out), False)


def derivative(state: tuple[tuple, bool], letters: frozenset) -> tuple[tuple, bool]:
    return settled([w for name, rest in state[0] if name in letters for w in ways(rest)])


class Dfa:
    """States by number: 0 is none, 1 the start. A row is a number, whose bits are the letters that fit it."""

    def __init__(self, pattern: object, letters: list[str]):
        if len(letters) > MOST_LETTERS:
            raise ValueError(f"more than {MOST_LETTERS} letters")
        if None in ways(pattern):
            raise ValueError("the pattern matches no rows")
        self.pattern, self.letters = pattern, letters
        self.sets = [frozenset(x for k, x in enumerate(letters) if m >> k & 1) for m in range(1 << len(letters))]
        self.states: list = []
        self.number: dict = {}
        self.table = np.full((16, len(self.sets)), -1, np.int32)
        self.ends, self.lives = np.zeros(16, bool), np.zeros(16, bool)
        self.known(((), False))
        self.known(settled(list(ways(pattern))))

    def known(self, state: tuple[tuple, bool]) -> int:
        k = self.number.setdefault(state, len(self.states))
        if k == len(self.states):
            self.states.append(state)
            if k == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.ends, self.lives = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ends, self.lives))
            self.ends[k], self.lives[k] = state[1], bool(state[0])
        return k

    def step(self, state: int, row: int) -> int:
        to = int(self.table[state, row])
        if to < 0:
            to = self.known(derivative(self.states[state], self.sets[row]))
            self.table[state, row] = to
        return to

    def steps(self, states: np.ndarray, rows: np.ndarray) -> np.ndarray:
        to = self.table[states, rows]
        new = np.flatnonzero(to < 0)
        if len(new):
            for s, r in set(zip(states[new].tolist(), rows[new].tolist())):
                self.step(s, r)
            to = self.table[states, rows]
        return to

    def all_states(self) -> frozenset:
        """Every state that lives, by any rows."""
        seen, new = {1}, [1]
        while new:
            s = new.pop()
            for row in range(len(self.sets)):
                to = self.step(s, row)
                if self.lives[to] and to not in seen:
                    seen.add(to)
                    new.append(to)
        return frozenset(seen)


@dataclass
class Rows:
    """masks: the letters that fit each row; those in `bound` also need a value no less than the first row's; stop: where
    each row's sequence ends."""

    masks: np.ndarray
    values: np.ndarray
    stop: np.ndarray
    bound: int


#: Steps that all starts take side by side, before those that still walk go on in groups.
TOGETHER = 128


def walk(dfa: Dfa, rows: Rows, at: np.ndarray, state: np.ndarray, first: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Walk from rows `at` in `state`; first: value of the start. Returns best (last row of the preferred match so far; as
    given, where there is none) and the state at the end of the sequence, 0 where the walk ended before."""
    at, state, best = at.copy(), state.astype(np.int32), best.copy()
    out = np.where(at < rows.stop[np.minimum(at, len(rows.stop) - 1)], 0, state) if len(rows.stop) else state.copy()
    live = np.flatnonzero(out == 0) if len(rows.stop) else np.empty(0, np.int64)
    stop = rows.stop[at[live]]
    for _ in range(TOGETHER):
        if not len(live):
            return best, out
        pos = at[live]
        mask = rows.masks[pos]
        mask = np.where(rows.values[pos] < first[live], mask & ~rows.bound, mask)
        to = dfa.steps(state[live], mask)
        ended = dfa.ends[to]
        best[live[ended]] = pos[ended]
        at[live] += 1
        state[live] = to
        goes, over = dfa.lives[to], pos + 1 >= stop
        out[live[goes & over]] = to[goes & over]
        live, stop = live[goes & ~over], stop[goes & ~over]
    _together(dfa, rows, at, state, first, best, out, live)
    return best, out


def _together(dfa: Dfa, rows: Rows, at: np.ndarray, state: np.ndarray, first: np.ndarray, best: np.ndarray, out: np.ndarray, live: np.ndarray) -> None:
    """The rest of the walks, row by row: all that are in one state at one row go on as a group, ordered by the start's value,
    where only a bound letter parts them. So a long sequence costs no square of its rows."""
    order = live[np.argsort(at[live], kind="stable")].tolist()
    masks, values, stop = rows.masks, rows.values, rows.stop
    groups: dict[int, tuple[list, int]] = {}  # state: (value, walk) in order, last row at which all have ended
    k, pos, end = 0, -1, -1

    def settle(members: list, last: int) -> None:
        if last >= 0:
            for _, w in members:
                best[w] = last

    def join(to: int, members: list, last: int, into: dict) -> None:
        if to not in into:
            into[to] = members, last
            return
        there, before = into[to]
        if before != last:
            settle(there, before)
            settle(members, last)
            last = -1
        small, large = sorted((members, there), key=len)
        if len(small) * 16 < len(large):
            for x in small:
                insort(large, x)
        else:
            large = sorted(large + small)
        into[to] = large, last

    while k < len(order) or groups:
        if not groups:
            pos = int(at[order[k]])
            end = int(stop[pos])
        if pos == end:
            for s, (members, last) in groups.items():
                settle(members, last)
                for _, w in members:
                    out[w] = s
            groups = {}
            continue
        while k < len(order) and at[order[k]] == pos:
            w = order[k]
            join(int(state[w]), [(int(first[w]), w)], -1, groups)
            k += 1
        mask, value, after = int(masks[pos]), int(values[pos]), {}
        for s, (members, last) in groups.items():
            high, low = dfa.step(s, mask), dfa.step(s, mask & ~rows.bound)
            parts = [(high, members)]
            if high != low:
                cut = bisect_right(members, (value, inf))
                parts = [(high, members[:cut]), (low, members)]
                del members[:cut]
            for to, part in parts:
                if part:
                    now = pos if dfa.ends[to] else last
                    if dfa.lives[to]:
                        join(to, part, now, after)
                    else:
                        settle(part, now)
        groups = after
        pos += 1


@lru_cache(maxsize=1 << 16)
def spelled(pattern: object, letters: tuple, masks: bytes) -> str:
    """The letters of the preferred match that takes exactly these rows (two bytes a row: the letters that fit)."""
    sets = [frozenset(x for k, x in enumerate(letters) if m >> k & 1) for m in np.frombuffer(masks, np.uint16).tolist()]
    threads: dict = dict.fromkeys((w for w in ways(pattern) if w is not None), None)
    for fits in sets:
        after: dict = {}
        for (name, rest), path in threads.items():
            if name in fits:
                for w in ways(rest):
                    after.setdefault(w, (path, name))
        last, threads = after, {w: p for w, p in after.items() if w is not None}
    path, out = last[None], []
    while path is not None:
        out.append(path[1])
        path = path[0]
    return "".join(reversed(out))
