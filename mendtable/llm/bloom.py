"""Two-pass Bloom filtering: which 64-bit hashes may occur more than once.

The first pass gives every task a pair of Bloom filters, one of the hashes it saw and one of those it
saw again. Merging two tasks ors the filters and adds to the second whatever both first filters
hold, so a hash that occurs twice anywhere always passes the second filter. The second pass tests
rows against it: a row that fails is certainly single.

The filter has 16 bits for each hash, at most ``MAX_BITS`` (128 MB). That bounds what the driver
holds and broadcasts. A larger input fills the filter, which lets more single rows through and
changes no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mixed, prepared, task

MAX_BITS = 1 << 30
SLICE_BITS = 1 << 20
HASHES = 2
#: Hashes a task gathers before it hands out a part.
PART = 1 << 22

PARTS = "slice int, once binary, again binary"
_PARTS = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("again", pa.binary())])


def filter_bits(rows: int) -> int:
    bits = SLICE_BITS
    while bits < min(16 * rows, MAX_BITS):
        bits *= 2
    return bits


def positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of each hash, one array for each hash function."""
    h = mixed(hashes.astype(np.uint64))
    step = (h >> np.uint64(33)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(HASHES)]


def parts(arrays: Iterable[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """A task's two filters, cut into slices that hold only the bits set."""
    waiting: list[np.ndarray] = []
    size = 0
    for a in arrays:
        waiting.append(a)
        size += len(a)
        if size >= PART:
            yield _part(waiting, bits)
            waiting, size = [], 0
    if size:
        yield _part(waiting, bits)


def _part(waiting: list[np.ndarray], bits: int) -> pa.RecordBatch:
    seen, n = np.unique(np.concatenate(waiting), return_counts=True)
    once = np.unique(np.concatenate(positions(seen, bits)))
    again = np.unique(np.concatenate(positions(seen[n > 1], bits)))
    edges = np.arange(0, bits + 1, SLICE_BITS)
    a, b = np.searchsorted(once, edges), np.searchsorted(again, edges)
    rows = []
    for i in np.flatnonzero(np.diff(a)).tolist():
        rows.append((i, _packed(once[a[i] : a[i + 1]] - edges[i]), _packed(again[b[i] : b[i + 1]] - edges[i])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS)], schema=_PARTS)


def _packed(found: np.ndarray) -> bytes:
    """Bit numbers of a slice: as they are while few, else as a bitmap."""
    if 4 * len(found) < SLICE_BITS // 8:
        return found.astype("<u4").tobytes()
    return np.packbits(_flags(found)).tobytes()


def _flags(found: np.ndarray) -> np.ndarray:
    out = np.zeros(SLICE_BITS, bool)
    out[found] = True
    return out


def _bitmap(data: bytes) -> np.ndarray:
    if len(data) == SLICE_BITS // 8:
        return np.frombuffer(data, np.uint8)
    return np.packbits(_flags(np.frombuffer(data, "<u4")))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the parts of each slice one by one; a task keeps two bitmaps for each slice it owns."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for i, once, again in zip(*(batch.column(c).to_pylist() for c in range(3))):
            a, b = _bitmap(once), _bitmap(again)
            if i in held:
                x, y = held[i]
                held[i] = (x | a, y | b | (x & a))
            else:
                held[i] = (a, b)
    rows = [(i, zlib.compress(y.tobytes(), 1)) for i, (_, y) in held.items() if y.any()]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            names=["slice", "again"],
        )


def repeated_filter(found: DataFrame, bits: int) -> Broadcast:
    """Merge the parts (see ``PARTS``) of all tasks and broadcast the filter of repeated hashes."""
    merged = found.repartition("slice").mapInArrow(task(_merge), "slice int, again binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    step = SLICE_BITS // 8
    for row in merged.toLocalIterator():
        bitmap[row.slice * step : (row.slice + 1) * step] = np.frombuffer(zlib.decompress(row.again), np.uint8)
    return found.sparkSession.sparkContext.broadcast(bitmap.tobytes())


def may_repeat(hashes: np.ndarray, data: bytes) -> np.ndarray:
    """Whether each hash passes the filter."""
    bitmap = np.frombuffer(data, np.uint8)
    out = np.ones(len(hashes), bool)
    for p in positions(hashes, 8 * len(bitmap)):
        out &= (bitmap[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1
    return out


def repeated_among(df: DataFrame, column: str, rows: int) -> Broadcast:
    """The filter of the hashes that occur more than once in a column of ``df``."""
    prepared(df.sparkSession)
    bits = filter_bits(rows)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from parts((b.column(0).to_numpy().view(np.uint64) for b in batches), bits)

    return repeated_filter(df.select(column).mapInArrow(task(first_pass), PARTS), bits)


def passes(column: Column, found: Broadcast) -> Column:
    """Whether a hash column passes the filter; only the hashes go through Python."""

    @F.arrow_udf(T.BooleanType())
    def test(h: pa.Array) -> pa.Array:
        return pa.array(may_repeat(h.to_numpy().view(np.uint64), found.value))

    return test(column)
