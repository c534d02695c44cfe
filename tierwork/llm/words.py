"""Words of Arrow text columns as 64-bit hashes, found and hashed with numpy over whole batches; shingles over them.

Words are runs of bytes other than space and \\t..\\r, with A-Z lower-cased. Texts of any length are hashed in windows of bounded size.
Two different words (or shingles) share a 64-bit hash with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.random.default_rng(20240521).integers(0, 2**64, 256, dtype=np.uint64)[_LOWER]  # by byte, letters already lower-cased
_R = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _powers:
        for r in (_R, pow(_R, -1, 1 << 64)):
            steps = np.full(WINDOW + 1, r, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _tables()
    out, done = np.empty(len(starts), dtype=np.uint64), 0
    while done < len(starts):
        first = int(starts[done])
        upto = int(np.searchsorted(ends, first + WINDOW, side="right"))
        if upto <= done:  # one word longer than a window
            total, at = 0, first
            while at < ends[done]:
                stop = min(at + WINDOW, int(ends[done]))
                total += int((_BASE[data[at:stop]] * power[: stop - at]).sum(dtype=np.uint64)) * pow(_R, at - first, 1 << 64)
                at = stop
            out[done] = total & _MASK
            done += 1
            continue
        s, e = starts[done:upto] - first, ends[done:upto] - first
        sums = np.zeros(int(e[-1]) + 1, dtype=np.uint64)
        np.cumsum(_BASE[data[first: first + int(e[-1])]] * power[: int(e[-1])], out=sums[1:])
        out[done:upto] = (sums[e] - sums[s]) * inverse[s]
        done = upto
    return mix(out ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the rows and of the end, bytes) of a text column; null rows have no bytes."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)


def row_pieces(at: np.ndarray, width: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``width`` bytes together, or one row."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + width, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def spans(column: pa.Array, longest: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, place of each row's first word and the end, bytes, word starts, word ends) for pieces of a batch.

    With ``longest``, longer words are cut into parts of that many bytes.
    """
    at, data = text_buffers(column)
    for lo, hi in row_pieces(at):
        begin, stop = int(at[lo]), int(at[hi])
        part = data[begin:stop]
        inside = ~_SPACE[part]
        cut = np.zeros(len(part) + 1, dtype=bool)
        cut[at[lo: hi + 1] - begin] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | cut[1:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:] | cut[1:-1]
        s, e = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        if longest and len(s) and int((e - s).max()) > longest:
            parts = (e - s + longest - 1) // longest
            first = np.repeat(s, parts)
            no = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
            last = np.repeat(e, parts)
            s = first + no * longest
            e = np.minimum(s + longest, last)
        yield lo, hi, np.searchsorted(s, at[lo: hi + 1] - begin), part, s, e


def words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, place of each row's first word and the end, word hashes) for pieces of a batch."""
    for lo, hi, first, part, s, e in spans(column):
        yield lo, hi, first, _hash_spans(part, s, e)


def hash_parts(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _hash_spans(part, starts, ends)


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


_COMBINE = np.random.default_rng(7).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes (sorted) of the runs of k words; all words as one run where there are fewer; none without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < k:
        return mix((hashes * _COMBINE[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    total = hashes[: n - k + 1] * _COMBINE[0]
    for i in range(1, k):
        total += hashes[i: n - k + 1 + i] * _COMBINE[i]
    return np.unique(mix(total + np.uint64(k)))


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its distinct shingles) for every row of a text column."""
    for lo, hi, at, hashes in words(column):
        for row in range(lo, hi):
            yield row, shingles(hashes[at[row - lo]: at[row - lo + 1]], k)
