"""Words and hashes of whole Arrow text columns, computed on their UTF-8 bytes with numpy.

Nothing here loops over characters or words in Python. A text is cut only at ASCII space and
tab to carriage return, so working on bytes gives the same words as working on characters.
Working memory is about forty bytes for each byte of the rows handled together; ``row_groups``
keeps that to a few megabytes of text, or to one text where a single one is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

GROUP_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, _MASK, 256, dtype=np.uint64, endpoint=True)


#: Two independent sets of values per byte, for hashes of 64 or 128 bits.
BYTE_VALUES = (_byte_values(11), _byte_values(12))
_powers_cache: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64 for i below at least ``n``."""
    if not _powers_cache or len(_powers_cache[0]) < n:
        size = 1 << max(16, (max(n, 1) - 1).bit_length())
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        _powers_cache[:] = tables
    return _powers_cache[0], _powers_cache[1]


def mix(z: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * base ** i``, for ``span_hash``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][:len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]``, the same wherever the span lies."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts]
               + (ends - starts).astype(np.uint64))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one longer row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high
        low = high


def grouped(column: pa.Array, limit: int = GROUP_BYTES
            ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, bytes and offsets of each group of rows of a text column."""
    data, offsets = text_buffer(column)
    for low, high in row_groups(offsets, limit):
        yield (low, high, data[offsets[low]:offsets[high]],
               offsets[low:high + 1] - offsets[low])


def row_edges(size: int, offsets: np.ndarray) -> np.ndarray:
    """True at the first byte of every row that has bytes."""
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    return edge[:size]


class Words(NamedTuple):
    starts: np.ndarray   # byte where each word begins
    ends: np.ndarray     # byte behind it
    first: np.ndarray    # per row, and once behind the last: index of its first word


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> Words:
    """All words of all rows; ``apart`` says which bytes separate words."""
    inside = ~apart[data]
    edge = row_edges(len(data), offsets)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, found: Words, which: int = 0) -> np.ndarray:
    return span_hash(running(BYTE_VALUES[which][data]), found.starts, found.ends)


def window_hashes(values: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``values[start:start + width]`` for every start."""
    return span_hash(running(values), starts, starts + width)


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Indices at which a window of ``width`` items of one row begins."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    return spread(first[:-1], counts)


def spread(lows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges ``low, low + 1, ...`` of the given lengths, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(lows - begin, counts)
