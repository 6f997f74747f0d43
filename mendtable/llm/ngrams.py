"""Character n-grams of the distinct words of texts, found for many texts at once.

Words are runs of bytes other than ASCII controls, white space, digits and punctuation, with A-Z
lower-cased. An n-gram is ``n`` neighbouring bytes of a word with a border byte at both ends; it is
known by its hash, cut to a number of buckets.
"""

from __future__ import annotations

import numpy as np

from .common import mixed, ranges
from .hashing import PIECE, distinct_spans, powers, prefix_sums

# what stands for a byte within words: itself, lower-cased; 0 for bytes that part words
_FOLDED = np.zeros(256, np.uint8)
for _b in range(256):
    _FOLDED[_b] = ord(chr(_b).lower()) if _b < 128 and chr(_b).isalpha() else _b if _b >= 128 else 0


def words_in(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts raw[ends[i]:ends[i + 1]]: the folded text with a 0 after each text, and
    the start, size and text number of each word in it."""
    n = len(ends) - 1
    folded = np.zeros(len(raw) + n + 1, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(ends))
    folded[np.arange(len(raw)) + owner + 1] = _FOLDED[raw]
    inside = folded != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, stops = edge[::2], edge[1::2]
    return folded, starts, stops - starts, np.searchsorted(ends + np.arange(n + 1), starts - 1, "right") - 1


def distinct_words(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of all texts, one after the other with a 0 around each, and where each
    starts and its size; and for each text and distinct word in it: the text, the word's number and
    how often it occurs."""
    folded, starts, sizes, text = words_in(raw, ends)
    _, first, number = distinct_spans(folded, starts, starts + sizes)
    n = max(1, len(first))
    pair, times = np.unique(text * np.int64(n) + number, return_counts=True)
    kept = sizes[first]
    at = np.cumsum(kept + 1) - kept
    letters = np.zeros(int((kept + 1).sum()) + 1, np.uint8)
    letters[ranges(at, kept)] = folded[ranges(starts[first], kept)]
    return letters, at, kept, pair // n, pair % n, times


def ngrams(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, lengths: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams of words with their borders, and the word of each."""
    found, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE)))
        lo, hi = int(starts[i]) - 1, int(starts[j - 1] + sizes[j - 1]) + 1
        total, down = prefix_sums(letters[lo:hi].astype(np.uint64) + np.uint64(1)), powers(hi - lo)[1]
        for n in lengths:
            count = np.maximum(sizes[i:j] + 3 - n, 0)
            at = ranges(starts[i:j] - 1 - lo, count)
            h = mixed((total[at + n] - total[at]) * down[at] + np.uint64(n))
            found.append((h % np.uint64(buckets)).astype(np.int64))
            owner.append(np.repeat(np.arange(i, j), count))
        i = j
    return np.concatenate(found), np.concatenate(owner)
