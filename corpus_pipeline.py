"""A corpus made ready for training: five stages, each one of the operators of ``mendtable.llm``.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read back as the next
stage's docs. All but the last return the columns of docs, whatever else they are; the last returns the
token ids. Null texts count as empty: they have no letter, so that the first stage rejects them. Where only
one of several rows stays, it is the one of least id, a null id coming last, and rows equal in every column
are one. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mendtable.llm import bpe, decontaminate, exact_dedup, language, simhash
from mendtable.llm.common import remove_written, stored, table, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one language has half the words or more stay; those without a letter, and mixtures
    and junk that no language fits, go. ``language.in_languages`` also takes a set of wanted languages."""
    return language.drop_unknown(docs)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def no_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", no_exact_copies),
    ("simhash_near_dedup", no_near_copies),
    ("benchmark_decontamination", no_benchmark_text),
    ("bpe_encoding", token_ids),
]

#: Mixture inference, SimHash and BPE are no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. Once a stage is written, what led to it is deleted."""
    docs, mark = table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        remove_written(spark, mark)
    return STAGES[-1][1](spark, docs, sf_dir)
