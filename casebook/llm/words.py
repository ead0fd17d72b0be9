"""Word hashes of whole texts, vectorised over Arrow string buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D, with A-Z
folded to lower case (in UTF-8 these bytes never occur inside a longer
character). Words are hashed without being cut into Python strings: with
powers ``R**i`` and prefix sums of ``byte * R**i`` (mod 2**64) the hash of
``bytes[s:e]`` is ``(P[e] - P[s]) * R**-s``, mixed to 64 uniform bits.

Texts are handled in slices of at most ``SLICE_BYTES`` bytes (a longer text
is a slice of its own), so memory does not follow the Arrow batch size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 32
_LOWER += 1
_EXACT = np.arange(256, dtype=np.uint64) + 1
_powers = {"n": 0}


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser (splitmix64): spreads every input bit over the 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``R**i`` and ``R**-i`` for i < n at least."""
    if _powers["n"] < n:
        size = max(n, SLICE_BYTES + 2)
        _powers.update(n=size, up=_power_table(_R, size), down=_power_table(_R_INV, size))
    return _powers["up"], _powers["down"]


def texts(column) -> pa.Array:
    """The column as one string array; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def slices(column, max_bytes: int = SLICE_BYTES):
    """``(first row, bytes, offsets)`` for consecutive rows of at most ``max_bytes`` together."""
    arr = texts(column)
    if not len(arr):
        return
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    _, off, data = arr.buffers()
    off = np.frombuffer(off, dtype=kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(arr):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
        hi = min(hi, len(arr))
        yield lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def prefix_hash(data: np.ndarray, fold: bool) -> np.ndarray:
    """``P`` with ``P[e] - P[s]`` the unscaled hash of ``data[s:e]``."""
    up, _ = powers(len(data) + 1)
    p = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if fold else _EXACT)[data] * up[:len(data)], out=p[1:])
    return p


def spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray):
    """Start and end of every run of bytes that are no breaks, and the first run of each row (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~breaks[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_spans(data: np.ndarray, offsets: np.ndarray):
    return spans(data, offsets, _SPACE)


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True):
    """Hash of every word and the first word of each row (one more at the end)."""
    starts, ends, rows = word_spans(data, offsets)
    _, down = powers(len(data) + 1)
    p = prefix_hash(data, fold)
    return mix((p[ends] - p[starts]) * down[starts]), rows


def run_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values (callers drop runs that cross rows)."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    n = len(h) - width + 1
    out = np.full(n, np.uint64(width * 0x632BE59BD9B4E019 & (2**64 - 1)))
    for k in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[k:k + n]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """For every row its sorted distinct shingle hashes: runs of ``width``
    words; the whole text for fewer words; none without words."""
    h, rows = word_hashes(data, offsets)
    runs = run_hashes(h, width)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= width:
            yield np.unique(runs[a:b - width + 1])
        elif b > a:
            yield run_hashes(h[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)
