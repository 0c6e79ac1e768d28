"""Vectorised text kernel shared by the corpus operators.

Everything here works on one Arrow batch inside a task: the batch's UTF-8 buffer is read once and words,
shingles and hashes come out of whole-array numpy operations, so no per-character Python runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
WORDS = 5  # words of a shingle
_MULT = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240607)
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_CODE[65:91] = _CODE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_pow = {"n": 0, "up": None, "down": None}


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _pow["n"] < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INV)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _pow[name] = np.multiply.accumulate(x)
        _pow["n"] = size
    return _pow["up"], _pow["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    if column.type != kind:
        column = column.cast(kind)
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = 1 << 19):
    """Row ranges of a column that hold about `limit` bytes each, so arrays stay in bounded memory."""
    if not len(column):
        return
    _, offsets = utf8(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def words(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 21):
    """Words `[^\\x20\\x09-\\x0D]+` of every row, A-Z lower-cased: hashes, row offsets into them, and first and past-last bytes.

    Bytes are taken in stretches of about `most` that end between words, so a very long text needs little more than its words.
    """
    if len(data) > most:
        parts, lo = [], 0
        while lo < len(data):
            hi = min(lo + most, len(data))
            while hi < len(data) and not _SPACE[data[hi]]:
                gap = np.flatnonzero(_SPACE[data[hi : hi + (1 << 16)]])
                hi = hi + int(gap[0]) if len(gap) else min(hi + (1 << 16), len(data))
            inner = offsets[(offsets > lo) & (offsets < hi)] - lo
            h, _, start, end = words(data[lo:hi], np.concatenate([[0], inner, [hi - lo]]), hi - lo)
            parts.append((h, start + lo, end + lo))
            lo = hi
        h, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
        return h, np.searchsorted(start, offsets), start, end
    n = len(data)
    rows = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= space[:-1]
    after = edge[1:].copy()
    after[:-1] |= space[1:]
    inside = ~space
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    up, down = _powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_CODE[data] * up[:n], out=total[1:])
        h = (total[end] - total[start]) * down[start]
        h = mix(h + U64(_MULT) * (end - start).astype(np.uint64))
    return h, np.searchsorted(start, offsets), start, end


def shingle(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words over an array of word hashes (rows are not looked at)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = h[:n] + U64(size)
        for k in range(1, size):
            out = out * U64(_BASE) + h[k : k + n]
    return mix(out)


def shingle_rows(h: np.ndarray, at: np.ndarray, size: int = WORDS):
    """For each row the array of its shingles in order; a row with fewer words gives its whole sequence as one."""
    every = shingle(h, size)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            yield every[a : b - size + 1]
        elif b > a:
            yield shingle(h[a:b], b - a)
        else:
            yield every[:0]


def lists(values: np.ndarray, ends: list[int] | np.ndarray, kind=None) -> pa.Array:
    """A list column from flat values and row lengths."""
    off = np.zeros(len(ends) + 1, dtype=np.int32)
    np.cumsum(ends, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, type=kind))
