"""What the operators share: tables in the shared folder, row keys, text batches."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendtable.functions.columns import ref
from mendtable.sources.workspace import discard, scratch_path


BATCH_SETTING, LARGEST_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_shipped: set[str] = set()


def prepared(spark: SparkSession) -> SparkSession:
    """Make a session fit for the operators' Python tasks.

    Batches of 4 MB in place of 64 bound what a task holds, unless the user has set a size. The package
    is handed to the executors once, as ``--py-files`` would, so that they need not have it installed.
    """
    if spark.conf.get(BATCH_SETTING) == LARGEST_BATCH:
        spark.conf.set(BATCH_SETTING, "4m")
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="mendtable-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder of ``spark.checkpoint.dir`` and read it back.

    The lineage ends there: losing an executor later repeats none of the work before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: The tables ``stored`` has written and nobody has removed.
_written: list[str] = []


def written() -> int:
    """How many tables there are to remove; marks a place for ``remove_written``."""
    return len(_written)


def remove_written(spark: SparkSession, since: int = 0, last: bool = False) -> None:
    """Delete the tables that ``stored`` has written since a mark, all but the last unless it shall go too. To be
    called when nothing reads them any more: the last one is written, or results are saved elsewhere."""
    stop = len(_written) - (not last)
    for path in _written[since:stop]:
        discard(spark, path)
    del _written[since:stop]


def slim(df: DataFrame, text: str, id_column: str) -> DataFrame:
    """Only the id, as ``doc_id``, and the text, as ``text``; a null text becomes empty."""
    return df.select(
        ref(id_column).cast("bigint").alias("doc_id"), F.coalesce(ref(text), F.lit("")).alias("text")
    )


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id; rows equal in both get equal results anyway."""
    return F.xxhash64(text)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the columns, null equal to null."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


def fold_of(id_column: str, folds: int) -> Column:
    return F.coalesce(F.crc32(ref(id_column).cast("bigint").cast("string")) % folds, F.lit(-1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use a value several times in an expression but compute it once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array in one buffer, and the row boundaries within it."""
    wide = column.cast(pa.large_string())
    if wide.offset or wide.null_count:
        wide = pa.concat_arrays([wide.fill_null("")])
    n = len(wide)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = wide.buffers()
    ends = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The rows of a string array as bytes, without decoding."""
    raw, ends = batch_bytes(column)
    data = raw.tobytes()
    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield data[s:e]


def text_groups(batch: pa.RecordBatch, most: int = 1 << 18) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Rows of a batch (id, text) in groups of about ``most`` bytes: ids, bytes, text borders."""
    raw, ends = batch_bytes(batch.column(1))
    n, at = batch.num_rows, 0
    while at < n:
        stop = min(n, max(at + 1, int(np.searchsorted(ends, ends[at] + most))))
        yield batch.column(0)[at:stop], raw[ends[at] : ends[stop]], ends[at : stop + 1] - ends[at]
        at = stop


_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What a worker keeps from task to task, made once. It keeps one such thing only: workers go from
    operator to operator, and what the last one needed takes memory from the next."""
    if name not in _kept:
        forget()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    _kept.clear()


def hand_back() -> None:
    """Give memory that is free back to the machine; idle workers would keep it from others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False):
    """A task over batches that leaves no memory behind, but for what it ``keeps`` for the next."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        yield from run(batches)
        hand_back()

    return tidy


def list_parts(column: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Where each row's part starts in the members of an array of structs; a null row has none."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    members = column.flatten()
    fields = {members.type.field(i).name: members.field(i) for i in range(members.type.num_fields)}
    return np.concatenate([[0], np.cumsum(sizes)]), fields


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (multiply, shift, multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1], dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
