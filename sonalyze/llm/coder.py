"""Adaptive context-mixing range coder for token ids, over many blocks at once.

Blocks are coded independently: each begins with fresh models. An id's probability is the weighted sum of three
predictions. Orders 2 and 1 each name the id that their counter holds for the two ids before, or for the one: it
counts up where the id comes again, down where it doesn't, and a counter at zero takes the new id. Order 0
spreads its part over all ids by the counts of their bytes so far. The weights are learned in each block, by how
far both counters are and whether they name the same id, whose weights then add up. The sums drive a range coder
with 64-bit states and 32-bit words; carries go back into words already put out. Blocks are the lanes of numpy
arrays: all of them code their t-th id in the same step.

A block has two streams: for each id, which order named it, or none; and the ids that none did, by order 0, whose
counts are of these alone. So each stream has all its lanes in every step, and the second is read first. Byte counts
are summed anew only now and then: in between, the second stream's places are looked up for many steps at once.
"""

from __future__ import annotations

import zlib

import numpy as np

U = np.uint64
BLOCK = 4096
#: Bits of a slot in a block's order-2 and order-1 tables; ids after which byte counts are summed anew, often at first.
BITS2, BITS1 = 12, 11
REFRESH = (0, 16, 48, 112, 240, *range(512, BLOCK, 512))
SURE, CLASSES = 4, 4
ONE, TOP = 1 << 16, U(1 << 32)
MASK = U(0xFFFFFFFF)
HASH1, HASH2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
SHIFTS = np.array([[32 - BITS2], [32 - BITS1]], np.uint32)


class Models:
    """Orders 2 and 1 of some blocks, and their weights; n_bytes is the width of an id."""

    def __init__(self, lanes: int, n_bytes: int):
        lane = np.arange(lanes)
        # an id and its counter, of two bits, in all slots of order 2, and behind these of order 1
        self.kind = np.dtype(np.uint32 if n_bytes < 4 else np.uint64)
        self.table = np.zeros((lanes << BITS2) + (lanes << BITS1), self.kind)
        self.slots = np.stack([lane << BITS2, (lanes << BITS2) + (lane << BITS1)])
        # of ONE: the weight of what order 2 names, and of what order 1 names where it isn't the same, by both
        # counters; behind those, of what both name
        alone = np.array([600, 8000, 22000, 40000], np.int32)
        both = np.maximum(alone.repeat(SURE), np.tile(alone, SURE)) * 3 // 2
        pairs = np.stack([np.concatenate([alone.repeat(SURE), both]), np.tile(np.array([400, 3000, 6000, 10000], np.int32), 2 * SURE)], 1)
        self.weights, self.base = np.tile(pairs, (lanes, 1)).view(np.int64).ravel(), lane * (2 * SURE * SURE)

    def predict(self, one: np.ndarray, two: np.ndarray) -> None:
        m = len(one)
        h = np.empty((2, m), np.uint32)
        np.multiply(one.astype(np.uint32, copy=False), HASH1, out=h[1])
        np.multiply(two.astype(np.uint32, copy=False), HASH2, out=h[0])
        h[0] += h[1]
        h >>= SHIFTS
        # order 2 and order 1
        self.at = self.slots[:, :m] + h
        self.held = self.table.take(self.at)
        self.ids, self.k = self.held >> 2, self.held.astype(np.uint8)
        self.k &= 3
        self.id2, self.id1 = self.ids
        self.same = self.id2 == self.id1
        mixed = self.same.view(np.uint8) << 4
        mixed += self.k[0] << 2
        mixed += self.k[1]
        self.w = self.base[:m] + mixed
        self.p = self.weights.take(self.w).view(np.int32).reshape(m, 2)
        self.p2 = self.p[:, 0]
        self.f1 = (ONE - 512) - self.p2
        np.minimum(self.f1, self.p[:, 1], out=self.f1)
        self.f1 *= ~self.same

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """hit1: order 1 named the id and order 2 another."""
        p = np.empty_like(self.p)
        p[:, 0], p[:, 1] = hit2, hit1
        p *= ONE - 1024 - 64
        p += 64
        p -= self.p
        p >>= 4
        p += self.p
        self.weights[self.w] = p.view(np.int64).ravel()
        hit = self.ids == ids
        up = hit.view(np.int8)
        step = up + up
        step -= 1
        step -= up & (self.k == SURE - 1)
        self.held += step.astype(self.kind)
        self.table[self.at] = np.where(self.k == 0, (ids.astype(self.kind, copy=False) << 2) + hit, self.held)


def interval(p2: np.ndarray, f1: np.ndarray, hit2: np.ndarray, none: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the part of what was named begins in ONE, and its width: order 2's, order 1's, and the rest."""
    both = p2 + f1
    low, width = np.where(none, both, np.where(hit2, 0, p2)), np.where(none, ONE - both, np.where(hit2, p2, f1))
    return low.astype(U), width.astype(U)


class Bytes:
    """Order 0 of some blocks."""

    def __init__(self, lanes: int, n_bytes: int):
        # a byte's counts, for each class of the byte above it
        self.counts = [np.ones((lanes, CLASSES if k else 1, 256), np.int32) for k in range(n_bytes)]
        self.starts: list[np.ndarray] = []

    def refresh(self, m: int) -> None:
        """Where the bytes begin in ONE, in the first m lanes. A byte's end is the next one's beginning, or ONE, which
        is 0 in 16 bits."""
        self.starts = []
        for c in self.counts:
            total = np.cumsum(c[:m], 2, dtype=np.int32)
            begin = np.zeros(total.size + 1, np.uint16)
            scaled = total[:, :, :-1] * ((ONE - 256) / total[:, :, -1:])
            begin[:-1].reshape(total.shape)[:, :, 1:] = scaled.astype(np.uint16) + np.arange(1, 256, dtype=np.uint16)
            self.starts.append(begin)

    def table(self, k: int, lane: np.ndarray, above: np.ndarray) -> np.ndarray:
        return lane * self.counts[k].shape[1] + above

    def count(self, k: int, at: np.ndarray) -> None:
        found = np.bincount(at)
        self.counts[k].reshape(-1)[: len(found)] += 24 * found.astype(np.int32)

    def width(self, k: int, at: np.ndarray, low: np.ndarray) -> np.ndarray:
        return self.starts[k].take(at + 1) - low


class Writer:
    def __init__(self, lanes: int, size: int):
        self.low, self.range, self.lane = np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U), np.arange(lanes)
        self.words, self.owner, self.before = np.zeros(size, U), np.zeros(size, np.int32), np.zeros(size, np.int64)
        self.n, self.last = 0, np.full(lanes, -1)

    def put(self, low: np.ndarray, width: np.ndarray) -> None:
        """Narrow the first lanes' ranges to [low, low + width) of ONE."""
        m = len(low)
        r, base = self.range[:m], self.low[:m]
        r >>= U(16)
        step = r * low
        base += step
        carry = np.flatnonzero(base < step)
        r *= width
        if len(carry):
            self.words[self.last[carry]] += U(1)
        small = np.flatnonzero(r < TOP)
        if len(small):
            held = base[small]
            self.emit(small, held >> U(32))
            base[small] = held << U(32)
            r[small] <<= U(32)

    def emit(self, own: np.ndarray, words: np.ndarray) -> None:
        k = len(own)
        if self.n + k > len(self.words):
            self.words, self.owner, self.before = (np.concatenate([x, np.zeros_like(x)]) for x in (self.words, self.owner, self.before))
        at = slice(self.n, self.n + k)
        self.words[at], self.owner[at], self.before[at] = words, own, self.last[own]
        self.last[own] = np.arange(self.n, self.n + k)
        self.n += k

    def finish(self) -> list[bytes]:
        """Words by lane."""
        self.emit(self.lane, self.low >> U(32))
        self.emit(self.lane, self.low & MASK)
        words = self.words[: self.n]
        while len(over := np.flatnonzero(words > MASK)):
            words[over] &= MASK
            np.add.at(words, self.before[over], U(1))
        owner = self.owner[: self.n]
        out = words[np.argsort(owner, kind="stable")].astype("<u4")
        return [p.tobytes() for p in np.split(out, np.cumsum(np.bincount(owner, minlength=len(self.low)))[:-1])]


class Reader:
    def __init__(self, words: list[bytes]):
        sizes = np.array([len(w) // 4 for w in words])
        self.words = np.append(np.frombuffer(b"".join(words), "<u4"), np.zeros(4, "<u4")).astype(U)
        self.at = np.cumsum(sizes) - sizes + 2
        self.code = self.words.take(self.at - 2, mode="clip") << U(32) | self.words.take(self.at - 1, mode="clip")
        self.range = np.full(len(words), 2**64 - 1, U)

    def part(self, m: int) -> np.ndarray:
        """Where in ONE the codes of the first m lanes lie; take() is next."""
        r = self.range[:m]
        r >>= U(16)
        return np.minimum(self.code[:m] // r, U(ONE - 1))

    def take(self, low: np.ndarray, width: np.ndarray) -> None:
        m = len(low)
        r, code = self.range[:m], self.code[:m]
        code -= r * low
        r *= width
        small = np.flatnonzero(r < TOP)
        if len(small):
            at = self.at[small]
            code[small] = code[small] << U(32) | self.words.take(at, mode="clip")
            r[small] <<= U(32)
            self.at[small] = at + 1


def active(lengths: np.ndarray, steps: int) -> list[int]:
    """The lanes that have a t-th id; lengths fall from lane to lane."""
    return np.searchsorted(-lengths, -np.arange(steps), "left").tolist()


def stretches(steps: int) -> list[tuple[int, int]]:
    ends = [t for t in REFRESH if t < steps] + [steps]
    return list(zip(ends[:-1], ends[1:]))


def encode(ids: np.ndarray, lengths: np.ndarray, n_bytes: int) -> tuple[list[bytes], list[np.ndarray]]:
    """Each lane's words, and its ids that order 0 has to name. ids: (lanes, steps); lengths fall from lane to lane."""
    lanes, steps = ids.shape
    models, out = Models(lanes, n_bytes), Writer(lanes, ids.size // 4 + 4 * lanes + 16)
    ids = np.ascontiguousarray(ids.T, np.uint32)
    zero, missed = np.zeros(lanes, np.uint32), np.zeros((steps, lanes), bool)
    for t, m in enumerate(active(lengths, steps)):
        x = ids[t, :m]
        models.predict(ids[t - 1, :m] if t else zero[:m], ids[t - 2, :m] if t > 1 else zero[:m])
        hit2, hit1 = models.ids == x
        hit1 &= ~hit2
        none = missed[t, :m] = ~(hit2 | hit1)
        out.put(*interval(models.p2, models.f1, hit2, none))
        models.learn(x, hit2, hit1)
    missed = np.ascontiguousarray(missed.T)
    return out.finish(), np.split(np.ascontiguousarray(ids.T)[missed], np.cumsum(missed.sum(1))[:-1])


def decode(words: list[bytes], lengths: np.ndarray, n_bytes: int, missed: list[np.ndarray]) -> np.ndarray:
    """The ids that encode() was given, (lanes, steps)."""
    lanes, steps = len(words), int(lengths.max(initial=0))
    models, source = Models(lanes, n_bytes), Reader(words)
    sizes = np.array([len(y) for y in missed])
    others, at_other = np.concatenate([*missed, np.zeros(1, np.uint32)]), np.cumsum(sizes) - sizes
    ids = np.zeros((steps, lanes), np.uint32)
    zero = np.zeros(lanes, np.uint32)
    for t, m in enumerate(active(lengths, steps)):
        models.predict(ids[t - 1, :m] if t else zero[:m], ids[t - 2, :m] if t > 1 else zero[:m])
        at = source.part(m).astype(np.int32)
        hit2, none = at < models.p2, at >= models.p2 + models.f1
        hit1 = ~(hit2 | none)
        source.take(*interval(models.p2, models.f1, hit2, none))
        x = ids[t, :m]
        x[:] = np.where(hit2, models.id2, models.id1)
        rest = np.flatnonzero(none)
        other = at_other[rest]
        x[rest] = others.take(other, mode="clip")
        at_other[rest] = other + 1
        models.learn(x, hit2, hit1)
    return ids.T


def encode_others(ids: list[np.ndarray], n_bytes: int) -> list[bytes]:
    """Each lane's words for its ids by order 0; none for no ids."""
    sizes = np.array([len(y) for y in ids])
    by = np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)]
    out: list[bytes] = [b""] * len(ids)
    if not len(by):
        return out
    lengths = sizes[by]
    lanes, steps = len(by), int(lengths[0])
    y = np.zeros((lanes, steps), np.uint32)
    y[np.arange(steps) < lengths[:, None]] = np.concatenate([ids[i] for i in by])
    y = np.ascontiguousarray(y.T)
    models, to, m = Bytes(lanes, n_bytes), Writer(lanes, y.size // 2 + 4 * lanes + 16), active(lengths, steps)
    for a, b in stretches(steps):
        models.refresh(m[a])
        edges = np.append(0, np.cumsum(m[a:b]))
        lane = np.arange(edges[-1]) - np.repeat(edges[:-1], m[a:b])
        own, above, puts = y[a:b, : m[a]][np.arange(m[a]) < np.array(m[a:b])[:, None]], np.zeros(len(lane), np.int64), []
        for k in range(n_bytes):
            byte = (own >> np.uint32(8 * (n_bytes - 1 - k)) & np.uint32(255)).astype(np.int64)
            at = models.table(k, lane, above) * 256 + byte
            low = models.starts[k].take(at)
            puts.append((low.astype(U), models.width(k, at, low).astype(U)))
            models.count(k, at)
            above = np.minimum(byte, CLASSES - 1)
        for e, f in zip(edges[:-1].tolist(), edges[1:].tolist()):
            for low, width in puts:
                to.put(low[e:f], width[e:f])
    for i, words in zip(by.tolist(), to.finish()):
        out[i] = words
    return out


def below(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The last of each row's 16 ascending numbers that isn't above at; the first never is."""
    found = np.bitwise_count((rows <= at[:, None]).view(U))
    return (found[:, 0] + found[:, 1]).astype(np.int64) - 1


def decode_others(words: list[bytes], sizes: np.ndarray, n_bytes: int) -> list[np.ndarray]:
    """The ids that encode_others() was given."""
    by = np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)]
    out = [np.empty(0, np.uint32)] * len(words)
    if not len(by):
        return out
    lengths = sizes[by]
    lanes, steps = len(by), int(lengths[0])
    models, source, m, lane = Bytes(lanes, n_bytes), Reader([words[i] for i in by]), active(lengths, steps), np.arange(lanes)
    ids = np.zeros((steps, lanes), np.uint32)
    for a, b in stretches(steps):
        models.refresh(m[a])
        fine = [s[:-1].reshape(-1, 16) for s in models.starts]
        coarse = [np.ascontiguousarray(s[:, 0]).reshape(-1, 16) for s in fine]
        seen: list[list[np.ndarray]] = [[] for _ in range(n_bytes)]
        for t in range(a, b):
            own, above = lane[: m[t]], 0
            for k in range(n_bytes):
                row = models.table(k, own, above)
                part = source.part(m[t]).astype(np.uint16)
                at = row * 16 + below(coarse[k].take(row, 0), part)
                at = at * 16 + below(fine[k].take(at, 0), part)
                low = models.starts[k].take(at)
                source.take(low.astype(U), models.width(k, at, low).astype(U))
                seen[k].append(at)
                byte = at & 255
                above = np.minimum(byte, CLASSES - 1)
                ids[t, : m[t]] |= byte.astype(np.uint32) << np.uint32(8 * (n_bytes - 1 - k))
        for k, at in enumerate(seen):
            models.count(k, np.concatenate(at))
    ids = np.ascontiguousarray(ids.T)
    for i, y, n in zip(by.tolist(), ids, lengths.tolist()):
        out[i] = y[:n]
    return out


HEADER = np.dtype([("ids", "<u4"), ("crc", "<u4"), ("others", "<u4"), ("bytes", "<u4"), ("other_bytes", "<u4")])


def encode_blocks(ids: np.ndarray) -> bytes:
    """Blocks of BLOCK ids, the last of fewer: each has its count, the crc32 of its ids as 32-bit integers, how many
    of them order 0 names, and the lengths of its streams, in a table before the blocks."""
    ids = np.ascontiguousarray(ids, "<u4")
    n_bytes = max(1, -(-int(ids.max(initial=0)).bit_length() // 8))
    n = -(-len(ids) // BLOCK)
    lengths = np.full(n, BLOCK)
    if n:
        lengths[-1] = len(ids) - (n - 1) * BLOCK
    lanes = np.zeros((n, BLOCK if n > 1 else len(ids)), "<u4")
    lanes.reshape(-1)[: len(ids)] = ids
    coded, missed = encode(lanes, lengths, n_bytes) if n else ([], [])
    others = encode_others(missed, n_bytes)
    head = np.zeros(n, HEADER)
    head["ids"], head["others"], head["bytes"], head["other_bytes"] = lengths, [len(y) for y in missed], [len(c) for c in coded], [len(c) for c in others]
    head["crc"] = [zlib.crc32(ids[k * BLOCK : k * BLOCK + lengths[k]].tobytes()) for k in range(n)]
    return b"CMR3" + bytes([n_bytes]) + np.array([n], "<u4").tobytes() + head.tobytes() + b"".join(x for pair in zip(coded, others) for x in pair)


def decode_blocks(data: bytes) -> np.ndarray:
    """The ids; ValueError where a block's checksum differs."""
    if data[:4] != b"CMR3":
        raise ValueError("not a file of token ids")
    n_bytes, n = data[4], int(np.frombuffer(data, "<u4", 1, 5)[0])
    head = np.frombuffer(data, HEADER, n, 9)
    sizes = np.stack([head["bytes"], head["other_bytes"]], 1).astype(np.int64).ravel()
    at = 9 + n * HEADER.itemsize + np.append(0, np.cumsum(sizes))
    lengths = head["ids"].astype(np.int64)
    if len(data) != at[-1]:
        raise ValueError("a file of token ids that is cut off")
    if not n:
        return np.empty(0, "<u4")
    parts = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    others = decode_others(parts[1::2], head["others"].astype(np.int64), n_bytes)
    ids = np.ascontiguousarray(decode(parts[::2], lengths, n_bytes, others), "<u4")
    for k in range(n):
        if zlib.crc32(ids[k, : lengths[k]].tobytes()) != head["crc"][k]:
            raise ValueError(f"block {k} of token ids is damaged")
    return ids.reshape(-1)[: lengths.sum()]
