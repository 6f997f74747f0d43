"""Exact duplicates by two-pass Bloom filtering.

A first pass over the hashes of all rows builds a filter of those that may repeat. Rows that fail it
are single and pass straight through; only the rest is shuffled and compared, by the SHA-256 of the
normalised text. Copies are counted before every shuffle, so a text that fills a third of the table
arrives as one row from each task, and the join back to its rows may be split by adaptive execution.

Null and empty texts are equal. Among equal texts the row with the smallest id stays; a null id is
larger than any other, and of rows equal in id and text one stays. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendtable.functions.columns import ref, unused_name

from .bloom import passes, repeated_among
from .common import slim, stored

SPACE = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def text_digest(text: Column) -> Column:
    """SHA-256 of the text after each run of white space became one space; null counts as empty."""
    return F.sha2(normalised(F.coalesce(text, F.lit(""))), 256)


def exact_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    keyed = stored(
        slim(docs, text, id_column)
        .select("doc_id", text_digest(F.col("text")).alias("text_sha256"))
        .withColumn("hash", F.xxhash64("text_sha256")),
        "digests",
    )
    found = repeated_among(keyed, "hash", keyed.count())
    tested = keyed.withColumn("repeats", passes(F.col("hash"), found))
    single = tested.filter(~F.col("repeats")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    return single.unionByName(_compared(tested.filter("repeats")))


def _compared(rows: DataFrame) -> DataFrame:
    """The decisions for rows that may repeat."""
    counted = rows.groupBy("text_sha256", "doc_id").agg(F.count("*").alias("n"))
    groups = counted.groupBy(F.col("text_sha256").alias("digest")).agg(
        F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size")
    )
    # read back, both sides of the join are plain shuffles, of which Spark may split a hot key
    joined = counted.join(stored(groups, "groups"), F.col("text_sha256") == F.col("digest"))
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    return each.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that fail the filter are not shuffled. Of the others the one to stay is the smallest in
    (id, digest of the whole row), found before the rows themselves are joined to that choice; rows
    equal in every column are one row.
    """
    digest, hashed, order = (unused_name(docs, n) for n in ("digest_", "hash_", "order_"))
    keyed = docs.withColumn(digest, text_digest(ref(text))).withColumn(hashed, F.xxhash64(digest))
    slim_keys = stored(keyed.select(F.col(hashed).alias("hash")), "hashes")
    found = repeated_among(slim_keys, "hash", slim_keys.count())
    tested = keyed.withColumn(order, passes(F.col(hashed), found))
    single = tested.filter(~F.col(order)).select(docs.columns)
    whole = F.struct(ref(id_column).isNull(), ref(id_column), F.sha2(F.to_json(F.struct("*")), 256))
    several = tested.filter(F.col(order)).withColumn(order, whole)
    chosen = several.groupBy(digest).agg(F.min(order).alias(order))
    kept = several.join(chosen.select(F.col(digest).alias("d"), F.col(order).alias("o")), (F.col(digest) == F.col("d")) & F.col(order).eqNullSafe(F.col("o")), "left_semi")
    return single.unionByName(kept.dropDuplicates([digest]).select(docs.columns))
