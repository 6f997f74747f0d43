"""Repeated word windows by compressed FM-indexes: one per shard, over a wavelet matrix.

Each shard indexes its texts as word numbers: the last column of the sorted suffixes, kept as one
packed bitmap for each bit of a number, with the count of ones before every 512 bits. The shard's
texts are streamed through it from their last word to the first. Each step extends the match by the
word before and gives the interval of suffixes that start with it, so one walk yields the matching
statistics of a text, cut off at the window: a match as long as the window is shortened by its last
word, to the suffixes around it that share a window's length. Where a full match has an interval of
two suffixes or more the window is reported. Many texts walk side by side. Shards that share an
anchor are merged by binary search (see ``stretches``).

Words are parted by runs of ASCII white space and compared unchanged. A word is removed if a window
that covers it starts anywhere else too. Null and empty texts have no words, texts shorter than the
window keep all; rows that share id and text are documents of their own; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import list_parts, task, texts_of
from .stretches import Words, covered, with_runs
from .suffix_array import common_prefixes, suffix_array

_BLOCK = 8  # words of 64 bits between two counts


class WaveletMatrix:
    """Rank over a sequence of numbers, a packed bitmap for each bit of them, high bit first."""

    def __init__(self, sequence: np.ndarray):
        self.depth = max(1, int(sequence.max(initial=0)).bit_length())
        self.levels = []
        left = sequence
        for level in range(self.depth - 1, -1, -1):
            bit = (left >> level & 1).astype(bool)
            padded = np.zeros((len(bit) // (64 * _BLOCK) + 1) * 64 * _BLOCK, bool)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).reshape(-1, _BLOCK)
            counts = np.concatenate([[0], np.cumsum(ones.sum(1, dtype=np.int64))])
            # bits before each word of its block, so that a rank reads one word
            inner = (np.cumsum(ones, 1, dtype=np.uint16) - ones).ravel()
            self.levels.append((words, counts, inner, len(bit) - int(bit.sum())))
            left = np.concatenate([left[~bit], left[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place, less the symbol's own start."""
        return self.follow(symbol, at) - self.follow(symbol, np.zeros_like(at))

    def follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (words, counts, inner, zeros) in zip(range(self.depth - 1, -1, -1), self.levels):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[word // _BLOCK] + inner[word] + np.bitwise_count(words[word] & mask)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at


class FmIndex:
    """Backward search over a text of numbers, in which 0 parts its pieces."""

    def __init__(self, text: np.ndarray, window: int):
        self.window = window
        order = suffix_array(text)
        shared = common_prefixes(text, order, window)
        # the suffixes that share a window's length with each suffix
        head = shared < window
        head[:1] = True
        begin = np.flatnonzero(head)
        kind = np.cumsum(head) - 1
        self.low, self.high = begin[kind], np.append(begin[1:], len(text))[kind]
        column = text[order - 1]
        self.matrix = WaveletMatrix(column)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text))])

    def matches(self, pieces: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Walk all pieces from their ends side by side; at each step: which pieces, the place in each,
        the suffixes that start with the match there, and its length."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.concatenate(pieces)
        stops = np.cumsum(sizes)
        n = self.high[-1] if len(self.high) else 0
        live = np.arange(len(pieces))
        low, high = np.zeros(len(pieces), np.int64), np.full(len(pieces), n)
        length = np.zeros(len(pieces), np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = live[sizes[live] > step]
            word = flat[stops[live] - 1 - step]
            both = np.concatenate([low[live], high[live]])
            ranks = self.matrix.rank(np.concatenate([word, word]), both) + self.before[np.concatenate([word, word])]
            a, b = ranks[: len(live)], ranks[len(live) :]
            found = b > a
            grown = np.where(found, length[live] + 1, 0)
            full = grown > self.window
            inside = np.minimum(a, n - 1)
            a = np.where(full, self.low[inside], np.where(found, a, 0))
            b = np.where(full, self.high[inside], np.where(found, b, n))
            grown = np.minimum(grown, self.window)
            low[live], high[live], length[live] = a, b, grown
            yield live, sizes[live] - 1 - step, np.stack([a, b]), grown


def repeated_by_index(window: int):
    def solve(pieces: list[bytes], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        cuts = [p.split(b" ") for p in pieces]
        number: dict[bytes, int] = {}
        numbers = [np.array([number.setdefault(w, len(number) + 1) for w in c], np.int64) for c in cuts]
        text = np.concatenate([x for n in numbers for x in (n, np.zeros(1, np.int64))])
        index = FmIndex(text, window)
        starts = np.cumsum(counts) - counts
        flags = np.zeros(int(np.sum(counts)), bool)
        kind = np.zeros(len(flags), np.int64)
        for which, place, interval, length in index.matches(numbers):
            full = length == window
            at = starts[which[full]] + place[full]
            low, high = interval[:, full]
            flags[at] = high - low > 1
            kind[at] = low
        several = np.flatnonzero(flags)
        return flags, several[np.unique(kind[several], return_index=True)[1]]

    return solve


def remove_repeated_words(docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = 35, gram: int = 8) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and kept (the text)."""

    found = with_runs(docs, Words(window, gram), repeated_by_index(window), text, id_column)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ends, runs = list_parts(batch.column(2))
            start, count = runs["start"].to_numpy(), runs["n"].to_numpy()
            for data, a, b in zip(texts_of(batch.column(1)), ends[:-1].tolist(), ends[1:].tolist()):
                words = data.split()
                kept, removed = words, 0
                if a < b:
                    gone = covered(start[a:b], count[a:b], window, len(words))
                    removed = int(gone.sum())
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                whole = b" ".join(kept)
                rows.append((len(words), removed, hashlib.sha256(whole).hexdigest(), whole.decode()))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return found.mapInArrow(task(run), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
