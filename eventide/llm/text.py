"""Vectorised word handling for tasks: Arrow text columns as byte arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D (every other
white-space character belongs to its word).  Null texts count as empty.  All
helpers work on slices of bounded size (``slices``), so a task's memory does
not follow its partition; a single text is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
LEAN_BYTES = 1 << 20     # slices of steps that judge row by row: their arrays take up to 45 times the text

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_multipliers = np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def multipliers(n: int) -> np.ndarray:
    """The first n of a fixed sequence of odd 64-bit multipliers."""
    global _multipliers
    if len(_multipliers) < n:
        with np.errstate(over="ignore"):
            at = np.arange(1, max(n, 256) + 1, dtype=np.uint64) * _STEP
        _multipliers = mix(at) | np.uint64(1)
    return _multipliers[:n]


def as_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64 if large else np.int32)[col.offset: col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]: offs[-1]], offs - offs[0]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """Record batches cut into slices of at most ``limit`` text bytes (or one row)."""
    for batch in batches:
        _, offs = as_bytes(batch.column(batch.schema.get_field_index(column)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
            hi = min(n, max(hi, lo + 1))
            yield batch.slice(lo, hi - lo)
            lo = hi


class Words:
    """The words of the texts of one slice: byte bounds, row bounds and, on demand, 64-bit hashes."""

    separators = _SPACE

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool):
        self.buf = _LOWER[buf] if lower else buf
        self.offs = offs
        n = len(buf)
        inside = ~self.separators[buf]
        cut = np.zeros(n + 1, bool)
        cut[offs] = True
        before = np.empty(n + 1, bool)
        before[0] = False
        before[1:] = inside
        here = np.empty(n + 1, bool)
        here[:n] = inside
        here[n] = False
        self.start = np.flatnonzero(here & (cut | ~before))
        self.end = np.flatnonzero(before & (cut | ~here))
        self.row_start = np.searchsorted(self.start, offs)   # words of row i: row_start[i]:row_start[i+1]
        self.inside = inside

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row_start)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A multilinear 64-bit hash of each word's bytes and length."""
        return span_hashes(self.buf, self.start, self.end, self.inside)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte spans (non-empty, ascending, disjoint); ``inside``: true at just their bytes, if at hand."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    size = end - start
    total = int(size.sum())
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    within = np.arange(total) - np.repeat(first, size)
    value = multipliers(int(size.max()))[within]
    data = buf[within + np.repeat(start, size)] if inside is None else buf[inside]
    value *= data.astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _STEP)


def windows(hashes: np.ndarray, row_start: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows inside rows, and the word each begins at."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n - k + 1, np.uint64)
    for j, m in enumerate(multipliers(k)):
        value += hashes[j: n - k + 1 + j] * m
    last = np.repeat(row_start[1:], np.diff(row_start))      # end of each word's row
    at = np.flatnonzero(np.arange(n - k + 1) + k <= last[: n - k + 1])
    return mix(value[at]), at


def code_points(buf: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (buf & 0xC0) != 0x80
