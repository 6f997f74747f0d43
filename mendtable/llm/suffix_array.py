"""Repeated substrings by suffix arrays: one per shard, by Larsson-Sadakane refinement in numpy, with
Kasai's common prefixes; shards that share an anchor are merged by binary search (see ``stretches``).

A byte is removed if a string of ``window`` bytes that covers it starts anywhere else too, in the same
document or another. Documents are UTF-8; null and empty texts have no bytes; texts shorter than the
window keep all. Rows that share id and text are documents of their own and so repeat each other; an
empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import list_parts, task, texts_of
from .stretches import Bytes, covered, with_runs

#: Text positions each lane of the prefix computation walks through.
LANE = 256


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order.

    The first order is that of as many symbols as fit one integer. Then only groups of suffixes that
    are still equal are refined, by the rank of what follows, and the order's depth doubles.
    """
    n = len(text)
    bits = max(1, int(text.max(initial=0)).bit_length())
    known = max(1, 63 // bits)
    padded = np.concatenate([text.astype(np.int64), np.zeros(known, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(known):
        key = key << bits | padded[j : j + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])[:n]
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    todo = np.flatnonzero(~(head & np.append(head[1:], True)))
    while len(todo):
        at = order[todo]
        follow = at + known
        key = rank[at] * (n + 1) + np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[todo] = at
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(head, todo, 0))
        todo = todo[~(head & np.append(head[1:], True))]
        known *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """How many symbols, ``most`` at most and none of them 0, each suffix shares with the one before.

    Going through the text, the number falls by one at most from one suffix to the next. Lanes of
    ``LANE`` positions each do so side by side.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(most + 2, text.dtype)])
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[:1]] = n
    shared = np.zeros(n, np.int32)
    at = np.arange(0, n, LANE)
    stop = np.minimum(at + LANE, n)
    length = np.zeros(len(at), np.int64)
    while len(at):
        a = padded[at + length]
        more = (a == padded[before[at] + length]) & (a != 0) & (length < most)
        length[more] += 1
        done = ~more
        shared[at[done]] = length[done]
        at[done] += 1
        length[done] = np.maximum(length[done] - 1, 0)
        if (at >= stop).any():
            live = at < stop
            at, stop, length = at[live], stop[live], length[live]
    return shared[order]


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces plus one, a 0 after each, and where each piece starts."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
    text = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8).astype(np.int64) + 1
    text[np.cumsum(sizes) - 1] = 0
    return text, np.cumsum(sizes) - sizes


def repeated_by_suffixes(window: int):
    def solve(pieces: list[bytes], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        text, starts = joined(pieces)
        order = suffix_array(text)
        equal = common_prefixes(text, order, window) >= window
        after = np.append(equal[1:], False)
        flags = np.zeros(len(text), bool)
        flags[order[equal | after]] = True
        # windows are numbered one after the other, without the last bytes of the pieces
        n = np.array(counts)
        number = np.zeros(len(text), np.int64)
        where = np.concatenate([np.arange(s, s + c) for s, c in zip(starts.tolist(), counts)])
        number[where] = np.arange(n.sum())
        return flags[where], number[order[after & ~equal]]

    return solve


def remove_repeated_bytes(docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = 200, gram: int = 64) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes)."""
    found = with_runs(docs, Bytes(window, gram), repeated_by_suffixes(window), text, id_column)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ends, runs = list_parts(batch.column(2))
            start, count = runs["start"].to_numpy(), runs["n"].to_numpy()
            for data, a, b in zip(texts_of(batch.column(1)), ends[:-1].tolist(), ends[1:].tolist()):
                kept, removed, spans = data, 0, 0
                if a < b:
                    gone = covered(start[a:b], count[a:b], window, len(data))
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    removed, spans = int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                rows.append((len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return found.mapInArrow(task(run), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
