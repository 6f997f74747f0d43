"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are runs of digits, letters and non-ASCII characters, with A-Z lower-cased. A window is 13
consecutive words of an item; an item of fewer is one window. Equal windows of all items are one *class*,
whatever number of items share it. Every text gives, for each run of ``w`` neighbouring ``k``-grams, the one
of least hash (the leftmost of equals). As k + w - 1 words are no longer than a window, a class has one
such gram, and an occurrence of it in a document gives the same gram there, so joining these fingerprints
finds it for certain. Each hit is then extended: at the place it tells, the document's words are
compared with those of the class, and those that are equal are hit. Hash collisions cost a
comparison and change nothing.

So a document is compared once with each class it may hold, and items come in afterwards: classes
of the same items share a list of them, and documents that hold the same lists share their union. A
preamble that many items and many documents have costs rows in proportion to both, not their product.

Items of 13 words or more use grams of 5; shorter items have a scheme of their own, laid out for the
shortest of them, which is used only where such items exist.

The fingerprints of the classes are broadcast if there are at most 20,000 (three numbers each, checked
before); otherwise the join is a shuffle, in which adaptive execution may split hot fingerprints. A
fingerprint keeps its place in 26 bits: a text of more than 67 million words, beyond what Spark holds in a
value, is not foreseen. Only documents with hits are read a second time.

Null and empty texts have no words and hit nothing; items without words never occur; a null item id is
listed as an empty one. Rows that share id and text get the same result; empty tables work.
"""

from __future__ import annotations

import string
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendtable.functions.columns import broadcast_if_small, ref, unused_name

from .common import let, same, slim, stored, text_key

# letters of both cases, as words are lower-cased after the split
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
GRAM = 5
#: The low bits of a fingerprint are its place in the text, the others its hash.
_PLACE_BITS = 26


def words_of(text: Column) -> Column:
    def lowered(w: Column) -> Column:
        ascii_only = F.octet_length(w) == F.char_length(w)
        return F.when(ascii_only, F.lower(w)).otherwise(
            F.translate(w, string.ascii_uppercase, string.ascii_lowercase)
        )

    return F.transform(F.filter(F.split(text, SEPARATORS, -1), lambda w: w != ""), lowered)


def fingerprints(hashes: Column, gram: int, width: int) -> Column:
    """The least of every ``width`` neighbouring grams, hash and place in one number."""
    place = F.lit((1 << _PLACE_BITS) - 1)

    def numbered(i: Column) -> Column:
        h = F.xxhash64(*(F.get(hashes, i + j) for j in range(gram)))
        return h.bitwiseAND(F.bitwise_not(place.cast("bigint"))).bitwiseOR(i.cast("bigint"))

    def least(grams: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(grams) - (width - 1))
        return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(grams, i, width))))

    grams = F.transform(F.sequence(F.lit(0), F.size(hashes) - gram), numbered)
    none = F.array().cast("array<bigint>")
    return F.when(F.size(hashes) >= gram + width - 1, let(grams, least)).otherwise(none)


def _listed(df: DataFrame, found: str) -> DataFrame:
    """One row per fingerprint: scheme, hash and place."""
    one = df.select("*", F.explode(found).alias("number")).drop(found)
    return one.select(
        "*",
        F.shiftright("number", _PLACE_BITS).alias("gram"),
        F.col("number").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("place"),
    ).drop("number")


def _schemes(classes: DataFrame, window: int) -> list[tuple[int, int, Column]]:
    """Gram, width and the classes they serve."""
    shortest = classes.filter(F.col("size") < window).agg(F.min("size")).first()[0]
    out = [(GRAM, window - GRAM + 1, F.col("size") >= window)]
    if shortest is not None:
        gram = min(GRAM, shortest)
        out.append((gram, shortest - gram + 1, F.col("size") < window))
    return out


def _digest(words: Column) -> Column:
    return F.sha2(F.array_join(words, " "), 256)


def _classes(benchmark: DataFrame, item_text: str, item_id: str, window: int) -> tuple[DataFrame, DataFrame]:
    """The different windows of all items: class (a digest), words and the list of items they are in, as a digest;
    and the lists: list, item."""
    items = benchmark.select(
        F.coalesce(ref(item_id).cast("string"), F.lit("")).alias("item"),
        words_of(F.coalesce(ref(item_text), F.lit(""))).alias("item_words"),
    ).filter(F.size("item_words") > 0)
    size = F.least(F.size("item_words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("item_words") - size + 1)
    windows = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("item_words", i, size))).alias("words"))
    held = windows.select("item", _digest(F.col("words")).alias("class"), "words")
    listed = stored(
        held.groupBy("class").agg(F.first("words").alias("words"), F.array_sort(F.collect_set("item")).alias("items")), "classes"
    ).withColumn("list", F.sha2(F.to_json(F.struct("items")), 256))
    lists = listed.dropDuplicates(["list"]).select("list", F.explode("items").alias("item"))
    return stored(listed.select("class", "words", F.size("words").alias("size"), "list"), "windows"), stored(lists, "lists")


def _found(
    docs: DataFrame, benchmark: DataFrame, text: str, id_column: str, item_text: str, item_id: str, window: int
) -> tuple[DataFrame, DataFrame]:
    """One row per document: doc_id, doc_key, n_words, n_hit and the set of item lists it holds, as a digest (null if
    none); and the items of each set: set, item."""
    keyed = slim(docs, text, id_column).withColumn("doc_key", text_key(F.col("text")))
    classes, lists = _classes(benchmark, item_text, item_id, window)
    schemes = _schemes(classes, window)

    def hashes(words: Column) -> Column:
        return F.transform(words, lambda w: F.xxhash64(w))

    def winnowed(h: Column) -> Column:
        return F.struct(F.size(h).alias("n_words"), *(fingerprints(h, g, w).alias(f"found{i}") for i, (g, w, _) in enumerate(schemes)))

    made = keyed.select("doc_id", "doc_key", let(hashes(words_of(F.col("text"))), winnowed).alias("made"))
    marked = stored(made.select("doc_id", "doc_key", "made.*"), "winnowed")

    hits = None
    for i, (gram, width, served) in enumerate(schemes):
        # a window has one fingerprint; a shorter item may have several, the first of which finds it
        one = F.slice(let(hashes(F.col("words")), lambda h: fingerprints(h, gram, width)), 1, 1)
        of_classes = _listed(classes.filter(served).select("size", one.alias("found")), "found")
        of_classes = of_classes.select(F.col("gram").alias("g"), "size", F.col("place").alias("class_place")).distinct()
        of_docs = _listed(marked.select("doc_id", "doc_key", "n_words", f"found{i}"), f"found{i}")
        met = of_docs.join(broadcast_if_small(stored(of_classes, "grams")), F.col("gram") == F.col("g"))
        start = F.col("place") - F.col("class_place")
        met = met.filter((start >= 0) & (start + F.col("size") <= F.col("n_words"))).select("doc_id", "doc_key", start.alias("start"), "size")
        hits = met if hits is None else hits.unionByName(met)
    hits = stored(hits.groupBy("doc_id", "doc_key").agg(F.collect_set(F.struct("start", "size")).alias("hits")), "hits")

    words = keyed.select(F.col("doc_id").alias("i"), F.col("doc_key").alias("k"), "text")
    met = words.join(hits, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("doc_key") == F.col("k")))
    met = met.dropDuplicates(["doc_id", "doc_key"]).select("doc_id", "doc_key", "hits", words_of(F.col("text")).alias("doc_words"))
    around = F.transform("hits", lambda h: F.struct(
        h["start"].alias("start"), h["size"].alias("size"),
        _digest(F.slice("doc_words", (h["start"] + 1).cast("int"), h["size"])).alias("class"),
    ))
    tried = met.select("doc_id", "doc_key", F.explode(around).alias("h")).select("doc_id", "doc_key", "h.start", "h.size", "h.class")
    proven = tried.join(classes.select(F.col("class").alias("c"), "list"), F.col("class") == F.col("c"))
    per_doc = proven.groupBy("doc_id", "doc_key").agg(F.array_sort(F.collect_list(F.struct("start", "size", "list"))).alias("hits"))
    runs = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), (h["start"] + h["size"]).cast("bigint").alias("stop")))
    held = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["list"])))
    per_doc = stored(per_doc.select("doc_id", "doc_key", _covered(runs).alias("n_hit"), held.alias("lists")), "overlaps")
    per_doc = per_doc.withColumn("set", F.sha2(F.array_join("lists", ","), 256))
    sets = per_doc.select("set", "lists").dropDuplicates(["set"]).select("set", F.explode("lists").alias("list"))
    items = sets.join(lists, "list").select("set", "item").distinct()
    told = marked.select("doc_id", "doc_key", F.col("n_words").cast("bigint").alias("n_words"))
    joined = told.join(per_doc.drop("lists"), same(told, per_doc, "doc_id", "doc_key"), "left")
    return joined.select(
        told["doc_id"], told["doc_key"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), "set"
    ), items


def overlaps(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", window: int = 13,
) -> DataFrame:
    """One row per document: doc_id, doc_key (tells rows of one id apart), n_words, n_hit, n_items,
    items (sorted ids of the items with windows that occur)."""
    found, items = _found(docs, benchmark, text, id_column, item_text, item_id, window)
    of_set = items.groupBy(F.col("set").alias("s")).agg(F.array_sort(F.collect_list("item")).alias("items"))
    joined = found.join(of_set, F.col("set") == F.col("s"), "left")
    return joined.select(
        "doc_id", "doc_key", "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _covered(runs: Column) -> Column:
    """Words in the union of runs that are sorted by their start."""
    zero = F.lit(0).cast("bigint")
    state = F.struct(zero.alias("reached"), zero.alias("total"))

    def add(s: Column, r: Column) -> Column:
        begin = F.greatest(s["reached"], r["start"])
        return F.struct(
            F.greatest(s["reached"], r["stop"]).alias("reached"),
            (s["total"] + F.greatest(zero, r["stop"] - begin)).alias("total"),
        )

    return F.aggregate(runs, state, add, lambda s: s["total"])


def contaminated() -> Column:
    """A document of which a twentieth or more is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def overlap_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, items = _found(docs, benchmark, "text", "doc_id", "text", "item_id", 13)
    of_set = items.groupBy(F.col("set").alias("s")).agg(
        F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("digest")
    )
    joined = found.join(of_set, F.col("set") == F.col("s"), "left")
    return joined.select(
        "doc_id", "n_words", "n_hit", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = _found(docs, benchmark, text, id_column, "text", "item_id", 13)[0].filter(contaminated())
    lost = stored(found.select(F.col("doc_id").alias("lost"), F.col("doc_key").alias("lost_key")).distinct(), "contaminated")
    key = unused_name(docs, "key_")
    keyed = docs.withColumn(key, text_key(F.coalesce(ref(text), F.lit(""))))
    gone = ref(id_column).cast("bigint").eqNullSafe(F.col("lost")) & (F.col(key) == F.col("lost_key"))
    return keyed.join(lost, gone, "left_anti").select(*[ref(c) for c in docs.columns])
