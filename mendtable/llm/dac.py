"""Token ids in directly addressable codes, written and read as files by Spark.

Ids are cut into chunks from their low bits up. Level 0 holds the first chunk of every id, level 1 the
second chunk of those that go on, and so on; one bit for each code of a level tells whether its id
goes on, and a directory holds the number of such bits before every 512. So id number i is found by
reading its chunk, ranking the bitmap to find its place one level up, and so on: nothing else is
decoded. The chunk widths are those that make the shard smallest.

A shard (the ``payload`` column) is, little-endian: ``DAC1``, the number of levels (uint32), the number
of ids (uint64), then for each level its width and number of codes (uint64 each), then for each level
the codes packed into 64-bit words and, except for the last level, the bitmap in 64-bit words and the
directory in uint32.

A token file is a Parquet table with a row for each shard: ``part``, ``seq`` (shards in order within
the part), ``first`` (ids of the part before the shard), ``n_tokens``, ``doc_ids``, ``lengths`` and
``payload``. Parts and shards follow ascending ids; a null id comes first, rows that share an id stand
together in any order. A null text is empty and holds the end id only. An empty table gives files
without shards. A document is never split, so the longest one bounds a shard.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mendtable.functions.columns import broadcast_if_small
from mendtable.sources.workspace import scratch_path

from .bpe import broadcast_vocabulary
from .common import kept, prepared, slim, stored, task, text_groups
from .segments import SegmentTable

MAGIC = b"DAC1"
#: A shard closes at the document that reaches this many ids.
SHARD_IDS = 1 << 19
#: Bytes of text in a part, on average.
PART_BYTES = 32 << 20
#: Parts whose sizes are summed in one group.
BLOCK = 1024
END_ID = 0
#: Segments a worker remembers, and bytes of text it looks up together: the library is slow on short
#: texts, so it pays to ask it rarely.
REMEMBERED = 2_000_000
GROUP = 1 << 20

SHARDS = "part int, seq int, first bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"

_ONE = np.uint64(1)


# ------------------------------------------------------------------ codes


def chunk_widths(ids: np.ndarray) -> list[int]:
    """Widths, low chunk first, that need the fewest bits for these ids."""
    top = max(1, int(ids.max(initial=0)).bit_length())
    beyond = [len(ids)] + [int((ids >> b != 0).sum()) for b in range(1, top)]
    best: list[tuple[int, list[int]]] = [(0, [])] * (top + 1)
    for b in range(top - 1, -1, -1):
        options = []
        for end in range(b + 1, top + 1):
            cost = beyond[b] * (end - b + (end < top))
            options.append((cost + best[end][0], [end - b, *best[end][1]]))
        best[b] = min(options)
    return best[0][1]


def _pack(codes: np.ndarray, width: int) -> np.ndarray:
    """Codes of ``width`` bits in 64-bit words; 64 codes fill ``width`` words, so column by column."""
    rows = -(-len(codes) // 64)
    grid = np.zeros(rows * 64, np.uint64)
    grid[: len(codes)] = codes
    grid = grid.reshape(rows, 64)
    words = np.zeros((rows, width), np.uint64)
    for j in range(64):
        word, off = divmod(j * width, 64)
        words[:, word] |= grid[:, j] << np.uint64(off)
        if off + width > 64:
            words[:, word + 1] |= grid[:, j] >> np.uint64(64 - off)
    return words.ravel()


def _bits(flags: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(flags) // 512) * 512, bool)
    padded[: len(flags)] = flags
    return np.packbits(padded, bitorder="little").view(np.uint64)


def encode_ids(ids: np.ndarray) -> bytes:
    """The shard of an array of ids."""
    left = ids.astype(np.uint64)
    widths = chunk_widths(ids)
    heads, bodies = [], []
    for level, width in enumerate(widths):
        heads += [width, len(left)]
        bodies.append(_pack(left & np.uint64((1 << width) - 1), width).tobytes())
        if level + 1 < len(widths):
            rest = left >> np.uint64(width)
            goes_on = rest != 0
            words = _bits(goes_on)
            ones = np.bitwise_count(words).reshape(-1, 8).sum(1)
            directory = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
            bodies += [words.tobytes(), directory.tobytes()]
            left = rest[goes_on]
    head = MAGIC + np.uint32(len(widths)).tobytes() + np.array([len(ids), *heads], "<u8").tobytes()
    return head + b"".join(bodies)


class Shard:
    """Random access to the ids of one shard."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a shard")
        n_levels = int(np.frombuffer(payload, "<u4", 1, 4)[0])
        head = np.frombuffer(payload, "<u8", 1 + 2 * n_levels, 8)
        self.n = int(head[0])
        at = 16 + 16 * n_levels
        self.levels = []
        for i in range(n_levels):
            width, codes = int(head[1 + 2 * i]), int(head[2 + 2 * i])
            size = -(-codes // 64) * width
            words = np.frombuffer(payload, "<u8", size, at)
            at += 8 * size
            bits = directory = None
            if i + 1 < n_levels:
                blocks = -(-codes // 512)
                bits = np.frombuffer(payload, "<u8", 8 * blocks, at)
                at += 64 * blocks
                directory = np.frombuffer(payload, "<u4", blocks, at)
                at += 4 * blocks
            self.levels.append((width, words, bits, directory))

    def ids(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, by rank alone."""
        out = np.zeros(len(places), np.uint64)
        live, at, shift = np.arange(len(places)), places.astype(np.int64), 0
        for width, words, bits, directory in self.levels:
            out[live] |= _codes(words, width, at) << np.uint64(shift)
            shift += width
            if bits is None or not len(live):
                break
            goes_on = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & _ONE == _ONE
            live, at = live[goes_on], _rank(bits, directory, at[goes_on])
        return out.astype(np.int64)

    def run(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``; neighbours stay neighbours on every level."""
        out = np.zeros(stop - start, np.uint64)
        live, first, count, shift = np.arange(stop - start), start, stop - start, 0
        for width, words, bits, directory in self.levels:
            out[live] |= _codes(words, width, np.arange(first, first + count)) << np.uint64(shift)
            shift += width
            if bits is None or not count:
                break
            word = first >> 6
            part = np.unpackbits(bits[word : ((first + count - 1) >> 6) + 1].view(np.uint8), bitorder="little")
            goes_on = part[first - 64 * word : first - 64 * word + count].astype(bool)
            first = int(_rank(bits, directory, np.array([first]))[0])
            live = live[goes_on]
            count = len(live)
        return out.astype(np.int64)


def _codes(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    bit = at * width
    word, off = bit >> 6, (bit & 63).astype(np.uint64)
    value = words[word] >> off
    over = off + np.uint64(width) > np.uint64(64)
    value[over] |= words[word[over] + 1] << (np.uint64(64) - off[over])
    return value & np.uint64((1 << width) - 1)


def _rank(bits: np.ndarray, directory: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Set bits before each place: the directory's number and at most eight words."""
    block = at >> 9
    out = directory[block].astype(np.int64) if len(at) else np.zeros(0, np.int64)
    for j in range(8):
        word = 8 * block + j
        free = np.clip(at - 64 * word, 0, 64)
        mask = np.where(free == 64, ~np.uint64(0), (_ONE << np.minimum(free, 63).astype(np.uint64)) - _ONE)
        out += np.bitwise_count(bits[word] & mask)
    return out


# ------------------------------------------------------------------ encoding with the tokenizers library

def library_table(vocabulary: Broadcast) -> SegmentTable:
    """The worker's table of segments encoded by the tokenizers library."""
    return kept(f"library {hash(vocabulary.value)}", lambda: _library_table(vocabulary.value))


def _library_table(vocabulary: str) -> SegmentTable:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    # letters of byte-level vocabularies stand for one byte each; special tokens are plain text
    special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    size_of = np.zeros(tokenizer.get_vocab_size() + len(special) + 1, np.int64)
    for token, i in tokenizer.get_vocab().items():
        size_of[i] = len(special[i].encode()) if i in special else len(token)

    def encode(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # segments that start with a space stay apart when written one after the other
        joined, members = [], []
        for i, s in enumerate(segments):
            if s[:1] == b" " and joined and len(members[-1]) < 64:
                joined[-1].append(s)
                members[-1].append(i)
            else:
                joined.append([s])
                members.append([i])
        found = tokenizer.encode_batch_fast([b"".join(j).decode() for j in joined], add_special_tokens=False)
        lists = [np.array(e.ids, np.int32) for e in found]
        ids = np.concatenate(lists)
        stops = np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))
        at = np.searchsorted(np.cumsum(size_of[ids]), stops)
        return ids, np.diff(np.concatenate([[-1], at]))

    return SegmentTable(encode, REMEMBERED, [t.encode() for t in special.values()])


# ------------------------------------------------------------------ files


def _shards(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = library_table(vocabulary)
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        waiting: list[tuple[list, np.ndarray, np.ndarray]] = []
        held = 0

        def closed() -> pa.RecordBatch:
            nonlocal seq, first, held, waiting
            ids = np.concatenate([w[1] for w in waiting])
            row = [part, seq, first, len(ids), sum((w[0] for w in waiting), []), np.concatenate([w[2] for w in waiting]), encode_ids(ids)]
            seq, first, held, waiting = seq + 1, first + len(ids), 0, []
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=["part", "seq", "first", "n_tokens", "doc_ids", "lengths", "payload"])

        for batch in batches:
            for keys, raw, ends in text_groups(batch, GROUP):
                ids, cuts = table.encode(raw, ends)
                whole = np.insert(ids, cuts[1:], END_ID)
                waiting.append((keys.to_pylist(), whole, np.diff(cuts) + 1))
                held += len(whole)
                if held >= SHARD_IDS:
                    yield closed()
        if waiting:
            yield closed()

    return run


def in_parts(rows: DataFrame, parts: int) -> DataFrame:
    """Rows (doc_id, text) by ranges of ids, ascending within each; an id that fills several ranges is dealt by its
    texts' hash. The plan is as large for many parts as for few."""
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def write_tokens(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id", vocabulary: str | None = None) -> None:
    """Encode every text, add the end id, and write the token files in ascending order of the ids."""
    rows = slim(docs, text, id_column)
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    parts = max(1, min((size.b or 0) // PART_BYTES + 1, size.n))
    encoded = broadcast_vocabulary(docs.sparkSession, vocabulary)
    in_parts(rows, parts).mapInArrow(task(_shards(encoded), keeps=True), SHARDS).write.parquet(path)


def part_offsets(shards: DataFrame) -> DataFrame:
    """For each part the ids of all parts before it: p, offset. Sums run within blocks of parts, and over the blocks."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("block", F.expr(f"part div {BLOCK}"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("n").alias("n")).select(F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.join(blocks, F.col("block") == F.col("b")).select(
        F.col("part").alias("p"), (F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("offset")
    )


def token_files(docs_or_spark, path: str) -> DataFrame:
    """The shards of token files, with ``offset``: the ids of all parts before."""
    spark = prepared(getattr(docs_or_spark, "sparkSession", docs_or_spark))
    shards = spark.read.schema(SHARDS).parquet(path)
    offsets = broadcast_if_small(stored(part_offsets(shards), "offsets"))
    return shards.join(offsets, F.col("part") == F.col("p")).drop("p")


def read_documents(spark, path: str) -> DataFrame:
    """What the token files hold for each document: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = Shard(row["payload"]).run(0, row["n_tokens"]).astype("<u4").tobytes()
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                sums = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["first"] + row["offset"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    shards = token_files(spark, path).select("first", "offset", "n_tokens", "doc_ids", "lengths", "payload")
    return shards.mapInArrow(task(run, keeps=True), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_between(spark, path: str, start: int, stop: int) -> DataFrame:
    """The ids numbered ``start`` to ``stop`` of all documents in order: number, id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                base = row["first"] + row["offset"]
                a, b = max(start - base, 0), min(stop - base, row["n_tokens"])
                ids = Shard(row["payload"]).run(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, b) + base, pa.int64()), pa.array(ids, pa.int64())], names=["number", "id"])

    at = F.col("first") + F.col("offset")
    shards = token_files(spark, path).filter((at < stop) & (at + F.col("n_tokens") > start))
    return shards.select("first", "offset", "n_tokens", "payload").mapInArrow(task(run), "number bigint, id bigint")


def written_and_read(docs: DataFrame, text: str = "text", id_column: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, text, id_column, vocabulary)
    return read_documents(docs.sparkSession, path)
