"""The append-only processing log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import local_table

# Fixed value: entries a report shows.
SHOWN_ENTRIES = 8
LOG_SCHEMA = "seq int, file_number int, message string"


class ProcessingLog:
    """Collects messages on the driver; they come from fits that already ran, never from new jobs."""

    def __init__(self, entries: Sequence[tuple[int, str]] = ()):
        self.entries: list[tuple[int, str]] = list(entries)

    def add(self, file_number: int, message: str) -> None:
        self.entries.append((file_number, message))

    def extend(self, other: ProcessingLog) -> None:
        self.entries.extend(other.entries)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, n, f"[File {n}] {m}") for i, (n, m) in enumerate(self.entries)]
        return local_table(spark, rows, LOG_SCHEMA)


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)


def log_head(log: DataFrame, n: int = SHOWN_ENTRIES) -> DataFrame:
    """The first ``n`` entries, each with how many more there are."""
    total = log.agg(F.count(F.lit(1)).alias("n")).scalar()
    return log.orderBy("seq").limit(n).withColumn("more", F.greatest(total - n, F.lit(0)))
