"""Word and byte arithmetic over Arrow columns in numpy: no Python object per word.

Hashes are polynomials over 64-bit integers: the hash of any span comes from two prefix sums and
one multiplication with an inverse power, so spans of every length cost the same.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that are worked on at once; a longer document is worked on alone.
CHUNK_BYTES = 1 << 19
NULL_ID = -(2**63)
BASE_BYTE, BASE_WORD, BASE_ALT = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F


def _is_separator() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


SEPARATOR = _is_separator()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit integers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=12)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, U64)
    out[0] = 1
    done, step = 1, base
    while done < size:
        n = min(done, size - done)
        out[done : done + n] = out[:n] * U64(step)
        done += n
        step = step * step % 2**64
    return out


def _sized(n: int) -> int:
    return 1 << max(10, int(n).bit_length())


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, _sized(n))[:n]


def inverse_powers(base: int, n: int) -> np.ndarray:
    return _powers(pow(base, -1, 2**64), _sized(n))[:n]


def prefix(codes: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of code times power, one longer than codes."""
    out = np.empty(len(codes) + 1, U64)
    out[0] = 0
    np.cumsum(codes * powers(base, len(codes)), out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the spans [start, end) from their prefix sums."""
    return mix((sums[ends] - sums[starts]) * inverse_powers(base, len(sums))[starts] + (ends - starts).astype(U64))


def windows(codes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of codes[i:i+size] for each i."""
    if len(codes) < size:
        return np.empty(0, U64)
    sums = prefix(codes, base)
    return mix((sums[size:] - sums[:-size]) * inverse_powers(base, len(sums))[: len(sums) - size])


@dataclass
class Chunk:
    """Whole texts of some consecutive rows: bytes, and where each text begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null reads as empty."""
    column = plain(column)
    if pa.types.is_null(column.type):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return body, offsets - offsets[0]


def ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Integer ids; null reads as the smallest integer."""
    return plain(column).cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's texts in runs of at most `most` bytes, or of one longer text."""
    data, offsets = buffers(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield Chunk(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


@dataclass
class Words:
    """Words of a chunk: where they begin and end, the text they are of, the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    bounds: np.ndarray
    codes: np.ndarray


def words(chunk: Chunk, lower: bool = False) -> Words:
    data = LOWER[chunk.data] if lower else chunk.data
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return Words(empty, empty, empty, np.zeros(chunk.n + 1, np.int64), np.empty(0, U64))
    solid = np.empty(n + 1, bool)
    solid[:n] = ~SEPARATOR[data]
    solid[n] = False
    begin, end = solid[:n].copy(), solid[:n].copy()
    begin[1:] &= ~solid[: n - 1]
    end &= ~solid[1:]
    inner = chunk.offsets[:-1]
    inner = inner[inner < n]
    begin[inner] = solid[inner]
    last = chunk.offsets[1:]
    last = last[last > 0] - 1
    end[last] = solid[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    bounds = np.searchsorted(starts, chunk.offsets)
    text = np.repeat(np.arange(chunk.n), np.diff(bounds))
    codes = spans(prefix(BYTE_CODE[data], BASE_BYTE), starts, ends, BASE_BYTE)
    return Words(starts, ends, text, bounds, codes)


def inside(bounds: np.ndarray, n_items: int, size: int) -> np.ndarray:
    """Starts of the windows of `size` items that lie in one text."""
    keep = np.zeros(n_items + 1, np.int32)
    room = bounds[1:] - bounds[:-1] >= size
    np.add.at(keep, bounds[:-1][room], 1)
    np.add.at(keep, bounds[1:][room] - size + 1, -1)
    return np.flatnonzero(np.cumsum(keep[:-1]) > 0)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i+width]) for each i."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


PLACE = U64((1 << 26) - 1)


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each `width` consecutive grams. It depends on those grams alone, so equal
    windows have their anchors at equal distances. Stretches that overlap keep places within their bits."""
    if len(grams) < width:
        return np.empty(0, np.int64)
    size, out = int(PLACE) + 1, []
    for lo in range(0, len(grams) - width + 1, size - width + 1):
        part = grams[lo : lo + size]
        tagged = (part & ~PLACE) | np.arange(len(part), dtype=U64)
        out.append((sliding_min(tagged, width) & PLACE).astype(np.int64) + lo)
    return np.concatenate(out) if len(out) > 1 else out[0]


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change, with the end."""
    if not len(keys[0]):
        return np.zeros(1, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), len(keys[0]))


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], tokens: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which gives free memory back to the system at its end. Executors keep their Python workers, so
    what one operator leaves is missing to the next: caches of token ids go, but where tokens are cut."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tokens and (module := sys.modules.get("sonalyze.llm.tokens")):
            module.release()
        yield from run(batches)
        trim()

    return tidy


def trim() -> None:
    """Give free memory back to the system: arrays of some MB come from the heap, which keeps it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it keeps
        pass
