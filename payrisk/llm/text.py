"""Vectorised word splitting and hashing over Arrow text columns.

Everything here works on the UTF-8 bytes of a slice of rows. Word classes of the operators treat all
code points from U+0080 on alike, so a byte table decides about them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once in a task; bounds the working memory of the array code.
SLICE_BYTES = 2 << 20
_CHUNK = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words that white space separates: all but space, tab, line feed to carriage return.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of digits, letters and code points above ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x41:0x5B] = True
ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
#: One random 64-bit value per byte; upper-case ASCII counts as lower case.
FOLDED = _VALUES[LOWER]
EXACT = _VALUES
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, _CHUNK + 4096), base, dtype=np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row bounds in them (nulls are empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    first = int(bounds[0])
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[first : int(bounds[-1])], bounds - first


def row_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` text bytes each, but of one row at least."""
    if len(column) == 0:
        return
    _, bounds = column_bytes(column)
    at, n = 0, len(column)
    while at < n:
        end = int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


class Words:
    """Words of a slice of rows: byte spans, and per row the range of its words."""

    def __init__(self, column: pa.Array, alphabet: np.ndarray):
        self.data, self.bounds = column_bytes(column)
        inside = alphabet[self.data]
        first, last = inside.copy(), inside.copy()
        if len(inside):
            cut = np.zeros(len(inside) + 1, dtype=bool)
            cut[self.bounds] = True
            first[1:] &= ~inside[:-1] | cut[1:-1]
            last[:-1] &= ~inside[1:] | cut[1:-1]
        self.inside = inside
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.starts, self.bounds)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.rows)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.per_row)

    def hashes(self, values: np.ndarray = FOLDED) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, values)


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = FOLDED
) -> np.ndarray:
    """64-bit hash of each byte span; spans are ascending and do not overlap.

    A polynomial of random byte values: prefix sums give all spans of a chunk in a few array steps.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            low = int(starts[at])
            stop = max(at + 1, int(np.searchsorted(ends, low + _CHUNK, side="right")))
            high = int(ends[stop - 1])
            total = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(values[data[low:high]] * _powers(_MULTIPLIER, high - low), out=total[1:])
            s, e = starts[at:stop] - low, ends[at:stop] - low
            poly = (total[e] - total[s]) * _powers(_INVERSE, high - low + 1)[s]
            out[at:stop] = mix(poly + (e - s).astype(np.uint64) * np.uint64(_MULTIPLIER))
            at = stop
    return out


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes; not symmetric."""
    with np.errstate(over="ignore"):
        return mix(left * np.uint64(0xD6E8FEB86659FD93) + right)


def hash_text(words: list[str]) -> np.ndarray:
    """Hashes of single words, as ``Words.hashes`` gives them."""
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
    starts = ends - np.array([len(w) for w in raw], dtype=np.int64)
    return span_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), starts, ends)


def row_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; ``rows`` are the n+1 bounds."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[rows[1:]] - total[rows[:-1]]
