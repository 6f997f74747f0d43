"""Polynomial hashes, modulo 2**64, of many parts of a buffer at once, and what parts are equal.

Different parts may share a hash, so equality is always decided by the bytes. A hash is the sum of value times power over a part, divided by the power at its start, so prefix sums
give the hash of every part. Buffers are worked on in pieces of ``PIECE``, whatever their length.
"""

from __future__ import annotations

import numpy as np

from .common import mixed, ranges

PIECE = 1 << 19

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_known: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first powers, n at least, of a base and of its inverse."""
    if which in _known and len(_known[which][0]) >= n:
        return _known[which]
    size = max(1 << 16, 1 << (int(n) - 1).bit_length())
    tables = []
    for b in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        tables.append(np.multiply.accumulate(p))
    made = (tables[0], tables[1])
    if size <= 4 * PIECE:  # larger ones are for one long word and not kept
        _known[which] = made
    return made


def prefix_sums(values: np.ndarray, which: int = 0) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), which)[0][: len(values)], out=total[1:])
    return total


def span_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of each span raw[start:stop]; spans ascend and do not overlap."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, lo + PIECE)))
        hi = int(stops[j - 1])
        total = prefix_sums(raw[lo:hi].astype(np.uint64) + np.uint64(1), which)
        a, b = starts[i:j] - lo, stops[i:j] - lo
        out[i:j] = mixed((total[b] - total[a]) * powers(hi - lo + 1, which)[1][a] + (b - a).astype(np.uint64))
        i = j
    return out


def equal_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a[start:start + size] and b[start:start + size] hold the same bytes, for each pair of starts."""
    out = np.ones(len(sizes), bool)
    total = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        done = int(total[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(total, done + PIECE, "right")))
        if j == i + 1:
            k = int(sizes[i])
            out[i] = np.array_equal(a[a_starts[i] : a_starts[i] + k], b[b_starts[i] : b_starts[i] + k])
        else:
            n = sizes[i:j]
            differ = a[ranges(a_starts[i:j], n)] != b[ranges(b_starts[i:j], n)]
            some = np.flatnonzero(n > 0)
            if len(some):
                out[i + some] = ~np.logical_or.reduceat(differ, (np.cumsum(n) - n)[some])
        i = j
    return out


def distinct_spans(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different spans raw[start:stop]; spans ascend and do not overlap.

    Hashes, ascending; one span for each number, those of the hashes first, then those whose hash
    another span has already; and the number of each span. Spans share a number exactly if equal.
    """
    seen, first, number = np.unique(span_hashes(raw, starts, stops), return_index=True, return_inverse=True)
    sizes, like = stops - starts, first[number]
    odd = sizes != sizes[like]
    there = np.flatnonzero(~odd & (like != np.arange(len(starts))))
    odd[there] = ~equal_spans(raw, starts[there], raw, starts[like[there]], sizes[there])
    extra: dict[bytes, int] = {}
    kept: list[int] = []
    for i in np.flatnonzero(odd).tolist():
        data = raw[starts[i] : stops[i]].tobytes()
        if data not in extra:
            extra[data] = len(seen) + len(kept)
            kept.append(i)
        number[i] = extra[data]
    return seen, np.append(first, np.array(kept, first.dtype)), number
