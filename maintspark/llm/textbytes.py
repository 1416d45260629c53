"""Words of whole texts as numpy arrays, straight from Arrow's UTF-8 buffers.

All word rules here are sets of ASCII bytes, and every byte of a multi-byte character is
0x80 or more, so words can be cut and lower-cased (A-Z) without decoding.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing)
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words of more bytes are hashed one by one.
_LONG = 64
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection): spreads every input bit over the whole value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n+1) of a string array; a null text has no bytes."""
    a = texts.cast(pa.large_string()).fill_null("")
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, col: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``max_bytes`` of text each (one row at least)."""
    _, off = buffers(batch.column(batch.schema.get_field_index(col)))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def lean(fn: Callable) -> Callable:
    """A batch function that gives its worker's free memory back when its task ends, so that
    idle workers don't hold it beside the next stage's."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)
    return run


class Words:
    """The words of some texts: byte ranges, 64-bit hashes, and per text the range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        self.data = low = _LOWER[data]
        n = len(low)
        inside = word_bytes[low]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.offsets = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        """One hash a word; never 0. Eight bytes at a time go through a mixing step that can be
        undone, so equally long words of up to eight bytes never collide, and no sum of
        powers can cancel out as it does in a polynomial modulo 2**64."""
        size = self.end - self.start
        h = mix(size.astype(np.uint64) * _BASE)
        padded = np.lib.stride_tricks.sliding_window_view(np.r_[self.data, np.zeros(8, np.uint8)], 8)
        live = np.flatnonzero(size <= _LONG)
        for at in range(0, _LONG, 8):
            live = live[size[live] > at]
            if not len(live):
                break
            eight = padded[self.start[live] + at].view("<u8").ravel() & _KEEP[np.minimum(size[live] - at, 8)]
            h[live] = mix(h[live] * _BASE + eight)
        for i in np.flatnonzero(size > _LONG):
            h[i] = xxhash.xxh3_64_intdigest(self.text(i))
        return np.where(h == 0, np.uint64(1), h)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def words(texts: pa.Array, word_bytes: np.ndarray) -> Words:
    return Words(*buffers(texts), word_bytes)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All of ``start[i] .. start[i]+length[i]-1``, one after another."""
    if not len(start):
        return np.zeros(0, np.int64)
    total = np.cumsum(length)
    return np.arange(total[-1]) + np.repeat(start - (total - length), length)
