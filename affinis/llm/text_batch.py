"""Words and shingles of a whole Arrow batch of texts with numpy, for use inside tasks.

Texts are handled in chunks of bounded size (one very long text is a chunk of its own), so
memory follows the chunk and not the batch. A null text has no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
CHUNK_BYTES = 1 << 20
#: Rows of a batch that are copied at once.
SLICE = 512

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _P = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def release() -> None:
    """Gives unused memory back to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` over the batches of a task, and ``release`` at its end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of a run of texts: ``data[start:end]`` each, in text order."""

    first: int  # row of the batch at which the run starts
    rows: int
    data: np.ndarray  # bytes of all texts
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray  # row of each word, counted from ``first``
    bounds: np.ndarray  # words of row r are bounds[r]:bounds[r + 1]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them) for runs of texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for base in range(0, len(texts), SLICE):
        part = texts.slice(base, SLICE).cast(pa.large_string()).fill_null("")
        n = len(part)
        _, off, data = part.buffers()
        off = np.frombuffer(off, np.int64)[part.offset : part.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield base + at, data[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to


def words(texts: pa.Array, lower: bool = True, limit: int = CHUNK_BYTES, breaks: np.ndarray = SPACE) -> Iterator[Words]:
    """Words of every text, as runs of bytes that are not ``breaks`` (white space)."""
    for first, data, off in chunks(texts, limit):
        rows = len(off) - 1
        if lower:
            data = LOWER[data]
        inside = ~breaks[data]
        if len(data):
            edge = off[:-1][off[:-1] < len(data)]
            before = np.empty_like(inside)
            before[0], before[1:] = False, inside[:-1]
            before[edge] = False
            after = np.empty_like(inside)
            after[-1], after[:-1] = False, inside[1:]
            after[edge[edge > 0] - 1] = False
            start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        else:
            start = end = np.zeros(0, np.int64)
        row = np.searchsorted(off, start, "right") - 1
        yield Words(first, rows, data, start, end, row, np.searchsorted(row, np.arange(rows + 1)))


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes at a time."""
    size = w.end - w.start
    padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(w.data) + 1,), "<u8", buffer=padded, strides=(1,))
    h = mix(size.astype(np.uint64) * _P)
    at, left, live = w.start.copy(), size.copy(), np.arange(len(size))
    while len(live):
        v = lanes[at]
        short = left < 8
        v[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[live] = mix((h[live] ^ v) * _P + _M2)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def shingle_hashes(w: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of all runs of ``size`` words inside one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes[:n].copy()
    for j in range(1, size):
        h = h * _P + hashes[j : n + j]
    whole = w.row[:n] == w.row[size - 1 :]
    return mix(h[whole]), np.flatnonzero(whole)
