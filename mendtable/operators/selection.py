"""Projections, filters, stacking, heads and top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import group_join, numeric_columns, ref

SOURCE = "source_file"

# Fallback width of a projection, rows shown per source, chart fallback width.
FALLBACK_COLUMNS = 8
HEAD_ROWS = 10
FIRST_NUMERIC = 4


def filter_non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(ref(column) != "")


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns; unknown names are skipped."""
    gone = set(columns)
    return df.select(*[ref(c) for c in df.columns if c not in gone])


def required_columns(
    names: Sequence[str], wanted: Sequence[str], group: str | None = None, source: str = SOURCE
) -> list[str]:
    """The columns a report reads, the source label in front.

    These are the wanted ones that the table has, and the group; a name comes once, at its first
    place. A table that has none of them is shown by its first ``FALLBACK_COLUMNS`` columns.
    """
    have = [n for n in names if n != source]
    known = [n for n in dict.fromkeys((*wanted, group)) if n in have]
    return [source, *(known or have[:FALLBACK_COLUMNS])]


def project_required(
    df: DataFrame, wanted: Sequence[str], group: str | None = None, source: str = SOURCE
) -> DataFrame:
    return df.select(*[ref(c) for c in required_columns(df.columns, wanted, group, source)])


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[ref(c) for c in numeric_columns(df)])


def select_first_n_numeric(df: DataFrame, n: int = FIRST_NUMERIC, skip: Sequence[str] = ()) -> DataFrame:
    return df.select(*[ref(c) for c in numeric_columns(df, skip)[:n]])


def with_source_column(df: DataFrame, label: str, source: str = SOURCE) -> DataFrame:
    return df.withColumn(source, F.lit(label))


def all_column_names(tables: Sequence[DataFrame]) -> list[str]:
    """Union of the column names of all tables, in first-seen order."""
    return list(dict.fromkeys(c for t in tables for c in t.columns))


def union_sources(tables: Mapping[str, DataFrame], source: str = SOURCE) -> DataFrame:
    """Stack labelled tables by column name; absent columns are null. Clashing types become text,
    integers and floats together become floats."""
    return stack_by_name([with_source_column(t, label, source) for label, t in tables.items()])


def stack_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, with types brought together as in ``union_sources``."""
    types: dict[str, dict[str, T.DataType]] = {}
    for t in tables:
        for f in t.schema.fields:
            types.setdefault(f.name, {})[f.dataType.simpleString()] = f.dataType
    common = {c: common_type(list(seen.values())) for c, seen in types.items() if len(seen) > 1}
    aligned = [
        t.select(*[ref(c).cast(common[c]).alias(c) if c in common else ref(c) for c in t.columns]) for t in tables
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def common_type(types: Sequence[T.DataType]) -> str:
    """The type that values of several types are brought to when they are stacked."""
    if len({t.simpleString() for t in types}) == 1:
        return types[0].simpleString()
    if all(isinstance(t, T.IntegralType) for t in types):
        return "bigint"
    return "double" if all(isinstance(t, T.NumericType) for t in types) else "string"


def head_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows; every task keeps ``n`` rows at most."""
    return df.orderBy(*[ref(o) for o in order_by]).limit(n)


def head_per_source(
    df: DataFrame, order_by: Sequence[str], n: int = HEAD_ROWS, source: str = SOURCE
) -> DataFrame:
    """The first ``n`` rows of each source with the source's row count as ``source_rows``.

    Each task cuts its part of a source to ``n`` rows before the shuffle, and the counts are a
    separate combined aggregate, so a hot source costs nothing extra.
    """
    w = Window.partitionBy(ref(source)).orderBy(*[ref(o) for o in order_by])
    heads = df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)
    counts = df.groupBy(ref(source)).agg(F.count(F.lit(1)).alias("source_rows"))
    return group_join(heads, counts, [source])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``column`` and ``count`` of each non-null value, most frequent first, ties by value."""
    return (
        df.filter(ref(column).isNotNull())
        .groupBy(ref(column))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), ref(column))
    )
