"""Which windows of fixed length occur more than once in a corpus: how shards are made and merged.

Comparing every window with every other shard would take work that grows with the square of the
corpus. So windows are sent where their equals are. Each window names its *anchor*, the gram of least
hash within it (the leftmost of equals), which depends on the window's content alone; equal windows
have equal anchors. Windows that follow one another mostly share an anchor, and such a run with the
text it covers is a *stretch*.

1. One pass over the texts finds the anchors that may occur more than once, by two-pass Bloom
   filtering. A window whose anchor is unique is unique.
2. A second pass writes where the other stretches are, each with a digest. Equal stretches are
   counted, not compared: a text that fills a third of the table is one stretch of many copies. The
   windows of a stretch that occurs twice all occur twice.
3. An anchor with different stretches needs a look inside: one copy of each is cut out of its text
   and goes to the shard of its anchor, where ``solve`` (an index over the shard) tells which windows
   occur more than once. An anchor with more than ``SPLIT`` different stretches is dealt over several
   shards. These hand out what they found single, and one of each kind found several times, and a
   merge sorts the digests and looks up by binary search which are known to more than one shard.
4. Verdicts return to the documents as runs of window starts.

Shards hold about ``SHARD_BYTES``, whatever the size of the corpus. Where the corpus outgrows the
filter of step 1 more stretches are counted in step 2, as a few numbers each; text is still cut out
only for anchors that differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import list_parts, mixed, prepared, same, slim, stored, task, text_groups, text_key, texts_of
from .hashing import powers, prefix_sums, span_hashes

SPLIT = 1024
SHARD_BYTES = 1_500_000
#: Units looked at together; longer texts are cut, with an overlap of one window.
CHUNK = 1 << 19

#: Stretches cut out of texts before they are handed on.
PIECES = 4096

_PLACE_BITS = np.uint64(26)
_PLACES = np.uint64((1 << 26) - 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: of a block's end and the next block's start."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def find_stretches(units: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """The stretches of the texts units[ends[i]:ends[i + 1]]: first window, windows, anchor hash."""
    none = np.zeros(0, np.int64)
    if len(units) < window:
        return none, none, none.view(np.uint64)
    total, down = prefix_sums(units), powers(len(units))[1]
    grams = mixed((total[gram:] - total[:-gram]) * down[: len(units) - gram + 1])
    ranked = (grams >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(ranked, window - gram + 1) & _PLACES).astype(np.int64)
    step = np.zeros(len(units) + 1, np.int32)
    long = np.diff(ends) >= window
    np.add.at(step, ends[:-1][long], 1)
    np.add.at(step, ends[1:][long] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(step[: len(anchor)]) > 0)
    if not len(at):
        return none, none, none.view(np.uint64)
    found = anchor[at]
    # a text border between neighbours shows as a gap, or as an anchor beyond the border
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(found) != 0)) + 1
    first = np.concatenate([[0], cut])
    return at[first], np.diff(np.append(first, len(at))), grams[found[first]]


@dataclass(frozen=True)
class Bytes:
    """Windows of bytes."""

    window: int
    gram: int

    def chunks(self, raw: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        """Units, text borders, and for each chunk the text and unit it starts at, and how to cut it."""
        for group, offset, lo, hi, borders in _chunks(ends, self.window):
            part = raw[lo:hi]
            data = part.tobytes()
            yield group, offset, part.astype(np.uint64) + np.uint64(1), borders, lambda p, n: data[p : p + n - 1 + self.window]

    def units(self, data: bytes) -> bytes:
        return data

    def cut(self, units: bytes, start: int, size: int) -> bytes:
        return units[start : start + size]


@dataclass(frozen=True)
class Words:
    """Windows of words, which any run of ASCII white space parts."""

    window: int
    gram: int

    def chunks(self, raw: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        data = raw.tobytes()
        cuts = [data[s:e].split() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
        borders = np.concatenate([[0], np.cumsum([len(c) for c in cuts])]).astype(np.int64)
        words = [w for c in cuts for w in c]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        joined = b" ".join(words)
        starts = np.cumsum(sizes + 1) - sizes - 1
        stops = starts + sizes
        units = span_hashes(np.frombuffer(joined, np.uint8), starts, stops)
        for group, offset, lo, hi, inner in _chunks(borders, self.window):
            yield group, offset, units[lo:hi], inner, lambda p, n: joined[starts[lo + p] : stops[lo + p + n + self.window - 2]]

    def units(self, data: bytes) -> list[bytes]:
        return data.split()

    def cut(self, units: list[bytes], start: int, size: int) -> bytes:
        return b" ".join(units[start : start + size])


def _chunks(ends: np.ndarray, window: int) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """Texts together, or overlapping parts of a long one: first text, offset in it, range, borders."""
    n, at = len(ends) - 1, 0
    while at < n:
        stop = min(n, max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK))))
        lo, hi = int(ends[at]), int(ends[stop])
        if stop == at + 1 and hi - lo > 2 * CHUNK:
            for s in range(lo, hi - window + 1, CHUNK):
                e = min(hi, s + CHUNK + window - 1)
                yield at, s - lo, s, e, np.array([0, e - s])
        else:
            yield at, 0, lo, hi, ends[at : stop + 1] - lo
        at = stop


#: Tells for the windows of some stretches (text, windows), one after the other, which occur more than
#: once, and gives one window of each kind that does.
Solver = Callable[[list[bytes], list[int]], tuple[np.ndarray, np.ndarray]]


def repeated_windows(docs: DataFrame, kind: Bytes | Words, solve: Solver) -> DataFrame:
    """Window starts that recur, for documents (doc_id, doc_key, text) that have any: doc_id, doc_key,
    runs (array of start and count)."""
    rows = stored(_stretches(docs, kind), "stretches")
    # the first copy met stands for all; its columns come from one row
    sample = [F.first(c).alias(c) for c in ("h", "n", "doc_id", "doc_key", "p0")]
    kinds = stored(rows.groupBy("key").agg(F.count("*").alias("copies"), *sample), "kinds")
    mixed_anchors = stored(
        kinds.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "anchors"
    )
    pieces = stored(_pieces(docs, kinds.join(mixed_anchors, "h"), kind), "pieces")
    solved = _solved(pieces, solve, kind)
    whole = kinds.filter("copies > 1").select("key", F.lit(0).alias("start"), "n")
    verdicts = stored(whole.unionByName(solved), "verdicts")
    found = rows.select("doc_id", "doc_key", "p0", "key").join(verdicts, "key")
    run = F.struct((F.col("p0") + F.col("start")).alias("start"), F.col("n").cast("bigint").alias("n"))
    return stored(found.groupBy("doc_id", "doc_key").agg(F.collect_set(run).alias("runs")), "runs")


def _stretches(docs: DataFrame, kind: Bytes | Words) -> DataFrame:
    """The stretches whose anchor may occur elsewhere: doc_id, doc_key, p0, n, h, key."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a window holds one new anchor in half as many places as it has grams
    step = max(1, (kind.window - kind.gram + 2) // 2) * (6 if isinstance(kind, Words) else 1)
    bits = bloom.filter_bits(size // step + 1)

    def first_pass(batches):
        def hashes():
            for batch in batches:
                for _, raw, ends in text_groups(batch, CHUNK):
                    for _, _, units, borders, _ in kind.chunks(raw, ends):
                        yield find_stretches(units, borders, kind.window, kind.gram)[2]

        yield from bloom.parts(hashes(), bits)

    found = bloom.repeated_filter(docs.select("doc_id", "text").mapInArrow(task(first_pass), bloom.PARTS), bits)
    names = ["doc_id", "doc_key", "p0", "n", "h", "key"]

    def second_pass(batches):
        for batch in batches:
            at = 0
            for ids, raw, ends in text_groups(batch, CHUNK):
                keys = batch.column(2)[at : at + len(ids)]
                at += len(ids)
                for group, offset, units, borders, piece_of in kind.chunks(raw, ends):
                    p, n, h = find_stretches(units, borders, kind.window, kind.gram)
                    kept = bloom.may_repeat(h, found.value)
                    p, n, h = p[kept], n[kept], h[kept]
                    if not len(p):
                        continue
                    inner = np.searchsorted(borders, p, "right") - 1
                    owner = pa.array(group + inner, pa.int64())
                    digests = [hashlib.md5(piece_of(a, b)).digest() for a, b in zip(p.tolist(), n.tolist())]
                    columns = [
                        ids.take(owner), keys.take(owner), pa.array(p - borders[inner] + offset, pa.int64()),
                        pa.array(n, pa.int32()), pa.array(h.view(np.int64), pa.int64()),
                        pa.array(digests, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, doc_key bigint, p0 bigint, n int, h bigint, key binary"
    return docs.select("doc_id", "text", "doc_key").mapInArrow(task(second_pass), schema)


def _pieces(docs: DataFrame, wanted: DataFrame, kind: Bytes | Words) -> DataFrame:
    """The text of the wanted stretches (key, h, n, kinds, doc_id, doc_key, p0): key, h, n, kinds, piece."""
    places = F.collect_list(F.struct("p0", "n", "kinds", "h", "key")).alias("places")
    by_doc = stored(wanted.groupBy("doc_id", "doc_key").agg(places), "wanted")
    found = docs.join(by_doc, same(docs, by_doc, "doc_id", "doc_key")).select("text", "places")
    names = ["key", "h", "n", "kinds", "piece"]

    def run(batches):
        for batch in batches:
            ends, of = list_parts(batch.column(1))
            start, n = of["p0"].to_numpy(), of["n"].to_numpy()
            done, waiting = 0, []
            for data, a, b in zip(texts_of(batch.column(0)), ends[:-1].tolist(), ends[1:].tolist()):
                units = kind.units(data)
                for at in range(a, b):
                    waiting.append(kind.cut(units, int(start[at]), int(n[at]) - 1 + kind.window))
                    if len(waiting) == PIECES or at + 1 == ends[-1]:
                        known = [of[c][done : at + 1] for c in names[:-1]]
                        yield pa.RecordBatch.from_arrays([*known, pa.array(waiting, pa.binary())], names=names)
                        done, waiting = at + 1, []

    pieces = found.mapInArrow(task(run), "key binary, h bigint, n int, kinds bigint, piece binary")
    # rows that repeat a document give its pieces again
    return pieces.dropDuplicates(["key"])


#: An open window on its way to the merge: its digest, and the stretch and place to tell. A window
#: known to occur several times in its shard asks for nothing and has place -1.
_OPEN = np.dtype([("a", ">u8"), ("b", ">u8"), ("key", "V16"), ("place", "<i4")])


def _solved(pieces: DataFrame, solve: Solver, kind: Bytes | Words) -> DataFrame:
    """Runs of repeated windows of each piece: key, start, n."""
    split = F.col("kinds") > SPLIT
    size = pieces.agg(
        F.sum(F.octet_length("piece")).alias("bytes"), F.sum(F.when(split, F.col("n"))).alias("open")
    ).first()
    shards = (size.bytes or 0) // SHARD_BYTES + 1
    buckets = (size.open or 0) // 100_000 + 1
    salt = F.pmod(F.xxhash64("key"), F.ceil(F.col("kinds") / SPLIT))
    shard = F.pmod(F.xxhash64("h", F.when(split, salt).otherwise(0)), F.lit(shards))
    dealt = pieces.select("key", "n", "piece", split.alias("split"), shard.cast("int").alias("shard"))

    def one_shard(t: pa.Table) -> pa.Table:
        keys, counts, texts = (t.column(c).to_pylist() for c in ("key", "n", "piece"))
        divided = t.column("split").to_numpy(zero_copy_only=False)
        flags, heads = solve(texts, counts)
        stops = np.cumsum(counts)
        starts = stops - counts
        edge = np.diff(flags.astype(np.int8), prepend=0)
        edge[starts[flags[starts]]] = 1
        begin = np.flatnonzero(edge == 1)
        clear = np.flatnonzero(~flags)
        after = np.append(clear, len(flags))[np.searchsorted(clear, begin)]
        owner = np.searchsorted(stops, begin, "right")
        after = np.minimum(after, stops[owner])
        n = len(begin)
        found = pa.table([
            pa.array([keys[o] for o in owner.tolist()], pa.binary()), pa.array(begin - starts[owner], pa.int32()),
            pa.array(after - begin, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
        ], names=["key", "start", "n", "bucket", "open"])
        return pa.concat_tables([found, opened(keys, texts, np.repeat(np.arange(len(keys)), counts), starts, flags, heads, divided)])

    def opened(keys, texts, owner, starts, flags, heads, divided) -> pa.Table:
        """What a shard hands out of anchors it shares with others, one row for each bucket."""
        asks = np.concatenate([np.flatnonzero(~flags & divided[owner]), heads[divided[owner[heads]]]])
        records = np.zeros(len(asks), _OPEN)
        if len(asks):
            of, place = owner[asks], asks - starts[owner[asks]]
            units = {o: kind.units(texts[o]) for o in set(of.tolist())}
            windows = (kind.cut(units[o], p, kind.window) for o, p in zip(of.tolist(), place.tolist()))
            digests = b"".join(hashlib.md5(w).digest() for w in windows)
            pair = np.frombuffer(digests, ">u8").reshape(-1, 2)
            records["a"], records["b"] = pair[:, 0], pair[:, 1]
            records["key"] = np.array(keys, "V16")[of]
            records["place"] = np.where(flags[asks], -1, place)
        bucket = (records["a"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        used, first = np.unique(bucket[order], return_index=True)
        packed = [r.tobytes() for r in np.split(records[order], first[1:])] if len(used) else []
        n = len(used)
        return pa.table([
            pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.array(used, pa.int32()),
            pa.array(packed, pa.binary()),
        ], names=["key", "start", "n", "bucket", "open"])

    schema = "key binary, start int, n int, bucket int, open binary"
    found = stored(dealt.groupBy("shard").applyInArrow(one_shard, schema), "shards")
    inside = found.filter("bucket IS NULL").select("key", "start", "n")

    def merge(t: pa.Table) -> pa.Table:
        records = np.frombuffer(b"".join(t.column("open").to_pylist()), _OPEN)
        ranked = records[np.argsort(records, order=("a", "b"))]
        new = (ranked["a"][1:] != ranked["a"][:-1]) | (ranked["b"][1:] != ranked["b"][:-1])
        label = np.concatenate([[0], np.cumsum(new)])
        # every shard lists a digest once at most, as single or as several
        many = np.searchsorted(label, label, "right") - np.searchsorted(label, label, "left") > 1
        hit = ranked[many & (ranked["place"] >= 0)]
        columns = [pa.array([k.tobytes() for k in hit["key"]], pa.binary()), pa.array(hit["place"].astype(np.int32)), pa.array(np.ones(len(hit), np.int32))]
        return pa.table(columns, names=["key", "start", "n"])

    merged = found.filter("bucket IS NOT NULL").select("bucket", "open").groupBy("bucket").applyInArrow(merge, "key binary, start int, n int")
    return inside.unionByName(merged)


def with_runs(docs: DataFrame, kind: Bytes | Words, solve: Solver, text: str, id_column: str) -> DataFrame:
    """Every document with its runs of repeated windows: doc_id, text, runs."""
    prepared(docs.sparkSession)
    keyed = slim(docs, text, id_column).withColumn("doc_key", text_key(F.col("text")))
    runs = repeated_windows(keyed, kind, solve)
    return keyed.join(runs, same(keyed, runs, "doc_id", "doc_key"), "left").select(keyed["doc_id"], "text", "runs")


def covered(start: np.ndarray, count: np.ndarray, window: int, n: int) -> np.ndarray:
    """Flags of the units that the windows of runs cover."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, start, 1)
    np.add.at(step, start + count + window - 1, -1)
    return np.cumsum(step[:n]) > 0
