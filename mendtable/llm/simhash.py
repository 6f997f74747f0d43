"""SimHash near-duplicates by pivot distance tables.

Words (runs of ASCII white space part them, A-Z is lower-cased) form shingles, each hashed by XXH64 with
seed 42; a fingerprint bit is set if more than half of the hashes have it. Fingerprints link if at most
``max_bits`` = 2 bits differ, and components of links are found over distinct fingerprints.

Of four blocks of 16 bits two differing bits leave two equal, so fingerprints meet in six tables, each
keyed by two blocks. Within a bucket, the distances of every fingerprint to ``PIVOTS`` reference
fingerprints are computed once. By the triangle inequality two fingerprints that link differ by two at
most in every coordinate, so pairs whose largest coordinate difference is greater are discarded, and
only survivors are compared. A bucket gives out a spanning forest of its links, not the pairs.

Buckets of more than ``BUCKET`` fingerprints take an exact way without pairs: fingerprints that are
equal in two blocks and differ by two bits are both one bit or none away from some point in between,
so each is listed under itself and its neighbours in the 32 free bits, and those listed together link.

A document without words has fingerprint zero and links like any other; with fewer words than a shingle
the whole sequence is one. A null text is empty. Ids may repeat (rows equal in id and text are one
document) or be null (a component of null ids only has a null id). An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendtable.functions.columns import ref, unused_name

from .common import mixed, prepared, slim, stored, task, text_key, texts_of
from .components import connected

SEED = 42
PIVOTS = 32
BUCKET = 2048
_SHINGLES = 1 << 15  # hashes whose bits are counted together

_PAIRS = list(combinations(range(4), 2))


def shingle_hashes(data: bytes, words: int) -> list[int]:
    """XXH64 of every shingle of a text given in UTF-8."""
    w = data.lower().split()
    if len(w) < words:
        return [xxhash.xxh64_intdigest(b" ".join(w), SEED)] if w else []
    return [xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(w[i:] for i in range(words))))]


def _bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints(texts: Iterator[bytes], words: int) -> Iterator[int]:
    """The fingerprint of each text, counted for many texts at once; long ones in parts."""
    waiting: list[list[int]] = []
    held = 0

    def counted() -> Iterator[int]:
        flat = np.array([h for w in waiting for h in w], np.uint64)
        sizes = np.array([len(w) for w in waiting])
        some = sizes > 0
        out = np.zeros(len(waiting), np.uint64)
        if some.any():
            starts = (np.cumsum(sizes) - sizes)[some]
            set_bits = 2 * _bit_counts(flat, starts) > sizes[some, None]
            out[some] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
        yield from out.tolist()

    for data in texts:
        hashes = shingle_hashes(data, words)
        if len(hashes) > _SHINGLES:
            yield from counted()
            waiting, held = [], 0
            total = sum(
                _bit_counts(np.array(hashes[i : i + _SHINGLES], np.uint64), np.zeros(1, np.int64))[0]
                for i in range(0, len(hashes), _SHINGLES)
            )
            yield int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])
            continue
        waiting.append(hashes)
        held += len(hashes)
        if held >= _SHINGLES:
            yield from counted()
            waiting, held = [], 0
    yield from counted()


def with_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, doc_key, fp for rows (doc_id, doc_key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(fingerprints(texts_of(batch.column(2)), words), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "doc_key", "fp"])

    return docs.select("doc_id", "doc_key", "text").mapInArrow(task(run), "doc_id bigint, doc_key bigint, fp bigint")


# ------------------------------------------------------------------ links


def pivots() -> np.ndarray:
    """Reference fingerprints, the same everywhere."""
    return mixed(np.arange(1, PIVOTS + 1, dtype=np.uint64))


def linked_pairs(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places within runs of equal keys whose fingerprints link."""
    table = np.bitwise_count(prints[:, None] ^ pivots()[None, :]).astype(np.int8)
    left, right = [], []
    at = np.arange(len(keys))
    for shift in range(1, len(keys)):
        at = at[at + shift < len(keys)]
        at = at[keys[at + shift] == keys[at]]
        if not len(at):
            break
        near = at
        for c in range(0, PIVOTS, 8):
            coordinates = table[near, c : c + 8] - table[near + shift, c : c + 8]
            near = near[np.abs(coordinates).max(1, initial=0) <= max_bits]
        near = near[np.bitwise_count(prints[near] ^ prints[near + shift]) <= max_bits]
        left.append(near)
        right.append(near + shift)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place it is connected to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def edges(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            left, right = linked_pairs(k, f, max_bits)
            if len(left):
                root = spanning(len(k), left, right)
                own = np.flatnonzero(root != np.arange(len(k)))
                ends = [pa.array(f[own].view(np.int64)), pa.array(f[root[own]].view(np.int64))]
                yield pa.RecordBatch.from_arrays(ends, names=["u", "v"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield from edges(keys[:whole], prints[:whole])
            keys, prints = keys[whole:], prints[whole:]
        yield from edges(keys, prints)

    return run


def _keys(max_bits: int) -> Column:
    """The six table keys of a fingerprint: the table and two of its four blocks."""
    if max_bits != 2:
        raise ValueError("the tables are laid out for 2 differing bits")

    def block(b: int):
        return F.shiftrightunsigned("fp", 16 * b).bitwiseAND(F.lit(0xFFFF))

    return F.array(*(F.lit(i << 32).cast("bigint") + F.shiftleft(block(a), 16) + block(b) for i, (a, b) in enumerate(_PAIRS)))


def _free_neighbours() -> Column:
    """The fingerprint and those one bit away in the blocks its table does not key."""
    out = F.lit(None).cast("array<bigint>")
    for i, (a, b) in reversed(list(enumerate(_PAIRS))):
        bits = [16 * c + j for c in range(4) if c not in (a, b) for j in range(16)]
        masks = [0] + [(1 << j) - (1 << 64 if j == 63 else 0) for j in bits]
        near = F.array(*(F.col("fp").bitwiseXOR(F.lit(m).cast("bigint")) for m in masks))
        out = F.when(F.shiftright("key", 32) == i, near).otherwise(out)
    return out


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints (fp) that link, directly or not."""
    listed = prints.select("fp", F.explode(_keys(max_bits)).alias("key"))
    heavy = stored(listed.groupBy("key").count().filter(F.col("count") > BUCKET).select("key"), "heavy")
    light = listed.join(heavy, "key", "left_anti")
    found = light.repartition("key").sortWithinPartitions("key").select("key", "fp").mapInArrow(task(_links(max_bits)), "u bigint, v bigint")
    crowded = listed.join(heavy, "key").withColumn("between", F.explode(_free_neighbours()))
    least = stored(crowded.groupBy("key", "between").agg(F.min("fp").alias("v")), "between")
    crowded_links = crowded.join(least, ["key", "between"]).filter("fp <> v").select(F.col("fp").alias("u"), "v")
    return found.unionByName(crowded_links)


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, and doc_key, which
    tells rows of one id apart."""
    prepared(docs.sparkSession)
    keyed = slim(docs, text, id_column).withColumn("doc_key", text_key(F.col("text")))
    prints = stored(with_fingerprints(keyed, words), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    roots = connected(links(distinct, max_bits))
    member = distinct.join(roots, distinct["fp"] == roots["u"], "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    member = stored(member, "members")
    least = stored(member.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    named = stored(member.join(least, "root").select(F.col("fp").alias("print"), "component_id"), "named")
    joined = prints.join(named, F.col("fp") == F.col("print"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "doc_key")


def drop_near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each component stays, the one with the smallest id, with all its columns."""
    found = stored(near_duplicates(docs, text, id_column, words, max_bits), "near")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key")
    # a component is told by its id; null ids have no component to tell, and stay
    best = stored(found.filter("component_id IS NOT NULL").groupBy("component_id").agg(F.min(first).alias("best")), "best")
    rows = found.join(best, "component_id").filter(~first.eqNullSafe(F.col("best"))).select(F.col("doc_id").alias("lost"), F.col("doc_key").alias("lost_key"))
    lost = stored(rows.distinct(), "lost")
    key = unused_name(docs, "key_")
    keyed = docs.withColumn(key, text_key(F.coalesce(ref(text), F.lit(""))))
    gone = ref(id_column).cast("bigint").eqNullSafe(F.col("lost")) & (F.col(key) == F.col("lost_key"))
    return keyed.join(lost, gone, "left_anti").select(*[ref(c) for c in docs.columns])
