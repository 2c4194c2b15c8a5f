"""Whole texts as byte arrays inside Arrow tasks: slices of bounded size, words, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] |= 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread all input bits over all output bits (64-bit finaliser)."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the row offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) with at most `limit` bytes of column `text`, or one longer row.

    At the end the task's worker, which waits for the next task, gives back the memory that batches had.
    """
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        row = 0
        while row < len(batch):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end
    pa.default_memory_pool().release_unused()


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return _LOWER[data]


def spaces(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def words(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the runs of `solid` bytes, of those that are no white space if not given.

    No word crosses rows.
    """
    solid = ~_SPACE[data] if solid is None else solid
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    first[bounds] = solid[bounds]
    last[bounds - 1] = solid[bounds - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which `span_hashes` gets the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _power(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts] + (ends - starts).astype(np.uint64))


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a binary column."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    body = np.ascontiguousarray(data[index])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).cast(pa.binary())


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each row."""
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return heads[offsets[1:]] - heads[offsets[:-1]]


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values in a sorted array."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.append(starts, len(keys)))
