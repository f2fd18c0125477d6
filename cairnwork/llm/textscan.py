"""Vectorised reading of Arrow text columns: blocks of bytes, word spans and span hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; working arrays take some tens of bytes for each.
BLOCK_BYTES = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z; all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2] if len(column) else None
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and body.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) for runs of rows of about limit bytes, one row at least."""
    data, offsets = raw(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        after = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, after, data[offsets[row] : offsets[after]], offsets[row : after + 1] - offsets[row]
        row = after


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, never across a row, and the number of the first run of each row (n + 1)."""
    n = len(inside)
    fresh, ending = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    fresh[:n] = inside
    fresh[1:n] &= ~inside[:-1]
    ending[1:] = inside
    ending[1:n] &= ~inside[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    fresh[cuts] = inside[cuts]
    ending[cuts] = inside[cuts - 1]
    starts, ends = np.flatnonzero(fresh), np.flatnonzero(ending)
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up, down = np.full(n, BASE, np.uint64), np.full(n, BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit of h over all others."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Sums of value * BASE^place, from which span_hash takes the hash of any run of values."""
    up, _ = _powers(max(16, int(len(values)).bit_length()))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the values in each [start, end); the same for the same values anywhere."""
    _, down = _powers(max(16, int(len(sums) - 1).bit_length()))
    return mix((sums[ends] - sums[starts]) * down[starts] + mix((ends - starts).astype(np.uint64)))


def window_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of width values, the place of the least (the leftmost of equals, judged by the upper 40 bits)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 24) - 1)
    keyed = (h & ~low) | (np.arange(len(h), dtype=np.uint64) & low)
    pad = -len(keyed) % width
    keyed = np.concatenate([keyed, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(keyed, axis=1).ravel()
    back = np.minimum.accumulate(keyed[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    return (least & low).astype(np.int64)
