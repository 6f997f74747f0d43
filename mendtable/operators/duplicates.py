"""Rows equal on all columns; nulls and NaN are equal to themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ref, small_table, unused_name
from ..functions.parsing import percent
from .frequencies import comparable

# Copies of one row are written out in chunks of this many.
COPY_CHUNK = 10_000


def duplicate_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``total_rows``, ``duplicate_count`` and ``duplicate_percent``; long text travels as digest."""
    keys = [comparable(ref(f.name), f.dataType).alias(f"__c{i}") for i, f in enumerate(df.schema)]
    groups = [ref(b) for b in by]
    counted = df.select(*groups, *keys).groupBy(
        *groups, *[f"__c{i}" for i in range(len(keys))]
    ).agg(F.count(F.lit(1)).alias("__cnt"))
    total = F.coalesce(F.sum("__cnt"), F.lit(0))
    copies = F.coalesce(F.sum(F.col("__cnt") - 1), F.lit(0))
    return counted.groupBy(*groups).agg(
        total.alias("total_rows"),
        copies.alias("duplicate_count"),
        percent(copies, total, 2).alias("duplicate_percent"),
    )


def _repeated(df: DataFrame) -> tuple[DataFrame | None, Column]:
    """Keys of rows that occur more than once, if they are few, and the test that finds the rows.

    Keys hold digests in place of long text, so finding them shuffles little even where rows are
    wide.
    """
    keys = [comparable(ref(f.name), f.dataType) for f in df.schema]
    counted = (
        df.select(*[k.alias(f"__k{i}") for i, k in enumerate(keys)])
        .groupBy(*[f"__k{i}" for i in range(len(keys))])
        .agg(F.count(F.lit(1)).alias("__cnt"))
    )
    few = small_table(counted.filter(F.col("__cnt") > 1).drop("__cnt"))
    test = F.lit(True)
    for i, k in enumerate(keys):
        match = k.eqNullSafe(F.col(f"__k{i}"))
        test = match if i == 0 else test & match
    return few, test


def duplicate_rows(df: DataFrame) -> DataFrame:
    """The extra copies themselves: a row that occurs n times comes out n - 1 times.

    Only rows that have copies are shuffled whole, where few enough do. Copies are counted
    map-side and written out again in chunks spread over tasks, so a row with very many copies
    never sits in one task.
    """
    n, chunk = unused_name(df, "__n"), unused_name(df, "__chunk")
    columns = [ref(c) for c in df.columns]
    size = F.lit(COPY_CHUNK)
    repeated, same = _repeated(df)
    suspects = df if repeated is None else df.join(repeated, same, "left_semi")
    extra = suspects.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias(n)).filter(F.col(n) > 0)
    chunked = extra.withColumn(
        chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / size)))
    )
    here = F.least(size, F.col(n) - F.col(chunk) * size)
    return (
        chunked.repartition(chunk, *columns)
        .withColumn(chunk, F.explode(F.sequence(F.lit(1).cast("long"), here.cast("long"))))
        .select(*columns)
    )


def drop_duplicates(df: DataFrame, long_text: bool = False) -> DataFrame:
    """Keep one copy of every row.

    With ``long_text`` rows are first compared by digest, and where few rows have copies only
    those are shuffled whole; all others pass through.
    """
    if not long_text:
        return df.dropDuplicates()
    repeated, same = _repeated(df)
    if repeated is None:
        return df.dropDuplicates()
    single = df.join(repeated, same, "left_anti")
    return single.unionAll(df.join(repeated, same, "left_semi").dropDuplicates())
