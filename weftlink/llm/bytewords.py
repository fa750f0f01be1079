"""Words, lines and hashes of Arrow string columns, computed on their bytes by numpy.

All functions take whole texts. Work is cut at document borders into slices of about
SLICE_BYTES so that temporary arrays stay small; one very long text is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
#: Odd multipliers and seeds of the two hash functions (any would do).
_SEEDS = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))
_ODD, _PAIR = _U(0xC2B2AE3D27D4EB4F), _U(0xA0761D6478BD642F)
#: Spans up to so many bytes are hashed side by side, longer ones one by one.
_SIDE_BY_SIDE = 128


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 borders of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, borders - borders[0]


def slices(borders: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most `most` bytes each, or of one document."""
    at, n = 0, len(borders) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(borders, borders[at] + most, "right")) - 1)
        yield at, to
        at = to


def word_spans(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each document's first word (n + 1 entries)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(borders), np.int64)
    word = ~_SPACE[data]
    fresh = np.ones(n + 1, bool)
    fresh[1:n] = ~word[:-1]
    fresh[borders] = True
    starts = np.flatnonzero(word & fresh[:n])
    last = fresh[1:].copy()
    last[:-1] = ~word[1:]
    last[borders[1:][borders[1:] > 0] - 1] = True
    ends = np.flatnonzero(word & last) + 1
    return starts, ends, np.searchsorted(starts, borders)


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each byte, as a number; past the end there are zeros."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _masked(blocks: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """blocks[at], of which only the first `left` bytes count."""
    found = blocks[at]
    short = np.flatnonzero(left < 8)
    found[short] &= (_U(1) << (left[short].astype(_U) << _U(3))) - _U(1)
    return found


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span; `which` chooses one of two independent functions.

    Short spans are taken eight bytes at a time, each block being mixed into the state by a
    bijection that is not linear, so no pattern of bytes cancels out; longer ones by XXH3.
    """
    size = ends - starts
    state = size.astype(_U) * _ODD ^ _SEEDS[which]
    if not len(size):
        return state
    blocks, live = _blocks(data), np.flatnonzero((size > 0) & (size <= _SIDE_BY_SIDE))
    done = 0
    while len(live):
        state[live] = mix(state[live] ^ _masked(blocks, starts[live] + done, size[live] - done))
        done += 8
        live = live[size[live] > done]
    raw = memoryview(np.ascontiguousarray(data))
    for i in np.flatnonzero(size > _SIDE_BY_SIDE):
        state[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]], seed=int(_SEEDS[which]))
    return state


def spans_equal(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """True where a[start : start + size] and b[start : start + size] are the same bytes."""
    same = np.ones(len(size), bool)
    left, right = _blocks(a), _blocks(b) if b is not a else None
    right = left if right is None else right
    live, done = np.flatnonzero((size > 0) & (size <= _SIDE_BY_SIDE)), 0
    while len(live):
        same[live] = _masked(left, a_starts[live] + done, size[live] - done) == _masked(right, b_starts[live] + done, size[live] - done)
        done += 8
        live = live[same[live] & (size[live] > done)]
    for i in np.flatnonzero(size > _SIDE_BY_SIDE):
        same[i] = np.array_equal(a[a_starts[i] : a_starts[i] + size[i]], b[b_starts[i] : b_starts[i] + size[i]])
    return same


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in this order."""
    return mix((left ^ (left >> _U(32))) * _PAIR + right)


def window_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside one document, and the word at which each starts.

    Runs are doubled until the next would be too long; two that overlap make the rest.
    """
    n = len(words)
    if n < size:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    ends = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(n) + size <= ends)
    runs, length = words, 1
    while 2 * length <= size:
        runs, length = _pair(runs[:-length], runs[length:]), 2 * length
    if length < size:
        runs = _pair(runs[: n - size + 1], runs[size - length :])
    return runs[at], at


def lower_ascii(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    return out


def tidy() -> None:
    """Give memory that freed arrays leave behind back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def tidied(f: Callable) -> Callable:
    """A map over record batches that tidies up after every batch and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                tidy()

        yield from f(fed())
        tidy()

    return run
