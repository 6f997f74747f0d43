"""Phrase collocation mining by direct-address tiling.

Phrases of two words and more are counted level by level. A phrase of k + 1 words is a pair of phrases of
k words that overlap in all but one, so each level counts pairs of the ids of the level below: ids are
ranks by frequency, the plane of pairs is cut into square tiles, tiles that hold many pairs are counted in
a dense table by ``bincount``, all others together as sorted coordinates. The pairs that are frequent are
ranked anew and are the ids of the next level. A group of a few megabytes of text is counted in a task at
a time; its counts go out as (language, phrase, count) and are summed by Spark, first within each task.

A phrase can only be frequent if both phrases it is made of are. The frequent phrases of a level are a
table, of which the tasks of the next level get a Bloom filter (128 MB at most, see ``bloom``): what it
lets through by mistake is counted and falls out later, so a fuller filter costs time and changes nothing.
Words and phrases are compared by their bytes; filters alone rest on hashes. The texts are read for words,
pairs and triples; that pass also hands out the runs of words in which all pairs may be frequent, and only
those are read for longer phrases.

Texts have A-Z lower-cased and are split into pieces at ``. , ; : ! ?`` and line breaks (U+000A to U+000D),
pieces into words at spaces and tabs; a phrase lies within one piece. Everything is counted by language;
a null language is ``und`` and a null text is empty. Of cuts of equal score the one after the fewest words
counts; equal phrases, ties in rank, go by score, count and the bytes of the phrase, so ranks are unique.
Repeated rows count as often as they stand there. An empty table gives an empty one; languages without a
candidate have no row. Other columns are ignored. A text is never split, so the longest one bounds a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mendtable.functions.columns import ref

from .bloom import may_repeat, repeated_among
from .common import prepared, ranges, stored, task, texts_of
from .hashing import distinct_spans

LONGEST = 4
LEAST = 30
TOP = 2000
COVERED = 80
#: Bytes of text that are counted together.
GROUP = 4 << 20
#: Ids on a tile's side, and pairs that make a tile worth a dense table.
SIDE = 512
DENSE = SIDE * SIDE // 16

_ROWS = "lang string, phrase string, n bigint, run boolean"
_SEED = 42

# what stands for a byte: itself, lower-cased; which bytes end pieces, and which are of words
_FOLDED = np.arange(256).astype(np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE = ~_ENDS
_INSIDE[[0x20, 0x09]] = False


# ------------------------------------------------------------------ counting within a group


def tiled_pairs(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of ids below ``n``, how often each occurs, and the number of each given pair.

    Ids are ranks, so that the pairs that occur often lie in few tiles.
    """
    across = -(-n // SIDE)
    tile = (left // SIDE) * np.int64(across) + right // SIDE
    order = np.argsort(tile, kind="stable")
    cuts = np.flatnonzero(np.diff(tile[order], prepend=-1, append=-1))
    rows, columns, times = [], [], []
    number = np.zeros(len(left), np.int64)
    made = 0
    sparse = np.ones(len(left), bool)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a < DENSE:
            continue
        here = order[a:b]
        sparse[here] = False
        cell = (left[here] % SIDE) * SIDE + right[here] % SIDE
        table = np.bincount(cell, minlength=SIDE * SIDE)
        full = np.flatnonzero(table)
        where, first = np.zeros(SIDE * SIDE, np.int64), here[0]
        where[full] = np.arange(made, made + len(full))
        number[here] = where[cell]
        rows.append(left[first] // SIDE * SIDE + full // SIDE)
        columns.append(right[first] // SIDE * SIDE + full % SIDE)
        times.append(table[full])
        made += len(full)
    rest = np.flatnonzero(sparse)
    code, back, count = np.unique(left[rest] * np.int64(n) + right[rest], return_inverse=True, return_counts=True)
    number[rest] = made + back
    rows.append(code // max(n, 1))
    columns.append(code % max(n, 1))
    times.append(count)
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(times), number


class Level:
    """The phrases of one length in a group: their words, how often each occurs, and what stands where.

    ``at`` holds the places (numbers of words of the group) at which a phrase of the level starts, ascending,
    and ``ids`` which phrase; ``words`` has a row for each phrase.
    """

    def __init__(self, words: np.ndarray, times: np.ndarray, at: np.ndarray, ids: np.ndarray):
        self.words, self.times, self.at, self.ids = words, times, at, ids

    def ranked(self, wanted: np.ndarray) -> Level:
        """The wanted phrases only, the most frequent first."""
        order = np.flatnonzero(wanted)
        order = order[np.argsort(-self.times[order], kind="stable")]
        rank = np.full(len(self.times), -1, np.int64)
        rank[order] = np.arange(len(order))
        ids = rank[self.ids]
        stays = ids >= 0
        return Level(self.words[order], self.times[order], self.at[stays], ids[stays])

    def longer(self, follows: np.ndarray | None = None) -> Level:
        """The phrases of one word more: pairs of phrases that start at neighbouring places. ``follows`` tells
        of each place whether the next one is in the same piece; longer phrases that overlap are in one."""
        near = np.flatnonzero(np.diff(self.at) == 1)
        if follows is not None:
            near = near[follows[self.at[near]]]
        left, right, times, number = tiled_pairs(self.ids[near], self.ids[near + 1], len(self.words))
        words = np.concatenate([self.words[left], self.words[right][:, -1:]], axis=1)
        return Level(words, times, self.at[near], number)


class Group:
    """The words of texts of one language."""

    def __init__(self, lang: str, texts: list[bytes]):
        # a break around each text, so that words and pieces end there
        raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        inside = _INSIDE[raw]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, stops = edge[::2], edge[1::2]
        piece = np.cumsum(_ENDS[raw], dtype=np.int32)[starts]
        self.lang, self.letters = lang, _FOLDED[raw]
        self.follows = np.append(piece[1:] == piece[:-1], False)
        _, first, number = distinct_spans(self.letters, starts, stops)
        self.starts, self.sizes, self.total = starts[first], (stops - starts)[first], len(starts)
        times = np.bincount(number, minlength=len(first))
        self.level = Level(np.arange(len(first))[:, None], times, np.arange(len(starts)), number)

    def phrases(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of phrases, words joined by spaces, in one buffer, and their borders."""
        sizes = self.sizes[words]
        ends = np.concatenate([[0], np.cumsum((sizes + 1).sum(1) - 1)])
        out = np.full(int(ends[-1]), 0x20, np.uint8)
        to = ends[:-1]
        for k in range(words.shape[1]):
            size = sizes[:, k]
            out[ranges(to, size)] = self.letters[ranges(self.starts[words[:, k]], size)]
            to = to + size + 1
        return out, ends

    def passing(self, level: Level, found: bytes) -> np.ndarray:
        """Which phrases of a level may be frequent."""
        raw, ends = self.phrases(level.words)
        data, seed = raw.tobytes(), xxhash.xxh64_intdigest(self.lang.encode(), _SEED)
        borders = ends.tolist()
        hashes = [xxhash.xxh64_intdigest(data[a:b], seed) for a, b in zip(borders, borders[1:])]
        return may_repeat(np.array(hashes, np.uint64), found)

    def rows(self, phrases: pa.Array, n: np.ndarray, run: bool = False) -> pa.RecordBatch:
        size = len(phrases)
        columns = [pa.repeat(self.lang, size), phrases, pa.array(n, pa.int64()), pa.repeat(run, size)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n", "run"])

    def counts(self, level: Level) -> pa.RecordBatch:
        raw, ends = self.phrases(level.words)
        found = pa.LargeStringArray.from_buffers(len(level.words), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw))
        return self.rows(found.cast(pa.string()), level.times)

    def runs(self, level: Level) -> pa.RecordBatch:
        """The longest rows of words whose phrases of this level all stand, if phrases two words longer fit in."""
        cut = np.flatnonzero(np.diff(level.at, prepend=-2, append=-2) != 1)
        first, last = cut[:-1], cut[1:] - 1
        long = last - first >= 2
        first, last = first[long], last[long]
        heads = level.words[level.ids]
        found = []
        for a, b in zip(first.tolist(), last.tolist()):
            words = [*heads[a : b + 1, 0].tolist(), *heads[b, 1:].tolist()]
            found.append(b" ".join([self.letters[self.starts[w] : self.starts[w] + self.sizes[w]].tobytes() for w in words]))
        return self.rows(pa.array(found, pa.binary()).cast(pa.string()), np.ones(len(found), np.int64), True)

    def word_total(self) -> pa.RecordBatch:
        """All words, under a phrase that is null."""
        return self.rows(pa.nulls(1, pa.string()), np.array([self.total]))


def _groups(batch: pa.RecordBatch) -> Iterator[Group]:
    """Texts of a batch (lang, text), by language and some megabytes at a time."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
        held.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text)
        if sizes[lang] >= GROUP:
            yield Group(lang, held.pop(lang))
            sizes[lang] = 0
    for lang, texts in held.items():
        yield Group(lang, texts)


# ------------------------------------------------------------------ tables


def _found(texts: DataFrame, filters: list[Broadcast | None], runs: bool = False) -> DataFrame:
    """How often each phrase occurs that has one word more than there are filters: lang, phrase, n, run; a phrase has
    a row for each group of texts. With ``runs`` also the runs that longer phrases are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch):
                level = group.level
                for k, found in enumerate(filters):
                    wanted = np.ones(len(level.times), bool) if found is None else group.passing(level, found.value)
                    level = level.ranked(wanted)
                    if runs and k + 1 == len(filters):
                        yield group.runs(level)
                    level = level.longer(group.follows if k == 0 else None)
                if len(level.words):
                    yield group.counts(level)
                if not filters:
                    yield group.word_total()

    return texts.mapInArrow(task(run), _ROWS)


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST
) -> DataFrame:
    """Phrases of one to ``longest`` words that occur ``least`` times or more: lang, phrase, n, size; and for each
    language a row of size 0 and null phrase with the number of all its words."""
    prepared(docs.sparkSession)
    texts = docs.select(F.coalesce(ref(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(ref(text), F.lit("")).alias("text"))
    filters: list[Broadcast | None] = []
    levels: list[DataFrame] = []
    for size in range(1, longest + 1):
        found = _found(texts, filters, runs=2 < size < longest)
        if 2 < size < longest:
            found = stored(found, f"found{size}")
            texts = found.filter("run").select("lang", F.col("phrase").alias("text"))
        summed = found.filter("NOT run").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        counted = summed.filter((F.col("n") >= least) | F.col("phrase").isNull())
        sized = F.when(F.col("phrase").isNull(), 0).otherwise(size).alias("size")
        levels.append(stored(counted.select("lang", "phrase", "n", sized), f"phrases{size}"))
        if size == longest:
            break
        hashes = levels[-1].filter("phrase IS NOT NULL").select(F.xxhash64("lang", "phrase").alias("hash"))
        # each twice: the filter is one of hashes that repeat
        frequent = repeated_among(hashes.union(hashes), "hash", 2 * hashes.count())
        # runs hold frequent phrases of the levels before only
        filters = [*filters, frequent] if size < 3 else [None] * (size - 1) + [frequent]
    return reduce(DataFrame.unionByName, levels)


def _scored(phrases: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: lang, phrase, size, a, l, r, score."""
    cuts = (
        phrases.filter("size > 1")
        .withColumn("words", F.split("phrase", " "))
        .withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select(
            "lang", "phrase", "size", F.col("n").alias("a"), "cut",
            F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("head"),
            F.array_join(F.slice("words", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("tail"),
        )
    )
    for part, count in (("head", "l"), ("tail", "r")):
        known = phrases.filter("size > 0").select(F.col("lang").alias("lang_"), F.col("phrase").alias("part"), F.col("n").alias(count))
        cuts = cuts.join(known, (F.col("lang") == F.col("lang_")) & (F.col(part) == F.col("part"))).drop("lang_", "part")
    # the quotient fits 64 bits, the product need not
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(lowest)
    return best.select("lang", "phrase", "size", "a", "lowest.l", "lowest.r", "lowest.score")


def _covered(phrases: DataFrame) -> DataFrame:
    """For each phrase within a longer candidate the greatest count of one: lang_, part, most."""
    inner = (
        phrases.filter("size > 2")
        .withColumn("words", F.split("phrase", " "))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .filter(F.col("start") + F.col("length") - 1 <= F.col("size"))
        .select(F.col("lang").alias("lang_"), F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("part"), "n")
    )
    return inner.groupBy("lang_", "part").agg(F.max("n").alias("most"))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
    covered: int = COVERED, top: int = TOP,
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score. A phrase is dropped if a longer
    candidate holds it and occurs at least ``covered`` percent as often."""
    phrases = frequent_phrases(docs, text, lang, least, longest)
    scored = stored(_scored(phrases), "scored")
    inside = _covered(phrases)
    match = (F.col("lang") == F.col("lang_")) & (F.col("phrase") == F.col("part"))
    share = F.expr(f"CAST(most AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {covered}")
    free = scored.join(inside, match, "left").filter(~F.coalesce(share, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # rows beyond the limit are cut before the shuffle, in every task
    first = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = phrases.filter("size = 0").select(F.col("lang").alias("lang_"), "n")
    return first.drop("lang_").join(totals, F.col("lang") == F.col("lang_")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score")
    )
