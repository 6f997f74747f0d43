"""Per-source summaries and cross tabulation of stacked tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import group_join, local_table, numeric_columns, quoted, ref, unpivot_as
from ..functions.parsing import is_missing
from ..sources.json_text import rows_as_json
from .frequencies import first_values
from .quantiles import grouped_quantiles
from .selection import SOURCE, head_n
from .statistics import count_distinct, null_percent

# Most categories a cross tabulation shows, sample values and rows of a profile.
TOP_CATEGORIES = 15
PROFILE_SAMPLES = 5
PROFILE_ROWS = 3


def _mean(df: DataFrame, c: str):
    present = F.when(~is_missing(quoted(c), df.schema[c].dataType), ref(c))
    return F.bround(F.avg(present).cast("double"), 2)


def source_summary(df: DataFrame, source: str = SOURCE) -> DataFrame:
    """Row count and ``avg_<column>`` of every numeric column per source."""
    means = [_mean(df, c).alias(f"avg_{c}") for c in numeric_columns(df, skip=[source])]
    return df.groupBy(ref(source)).agg(F.count(F.lit(1)).alias("row_count"), *means)


def entity_stats(df: DataFrame, source: str = SOURCE) -> DataFrame:
    """Mean of every numeric column per source, two decimals."""
    means = [_mean(df, c).alias(c) for c in numeric_columns(df, skip=[source])]
    return df.groupBy(ref(source)).agg(*means) if means else df.select(ref(source)).distinct()


def source_records(df: DataFrame, source: str = SOURCE) -> DataFrame:
    return df.groupBy(ref(source)).agg(F.count(F.lit(1)).alias("records"))


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def describe_by_source(df: DataFrame, source: str = SOURCE) -> DataFrame:
    """``mean``, ``median``, ``min`` and ``max`` per source and numeric column, two decimals."""
    names = numeric_columns(df, skip=[source])
    key = ref(source)
    doubles = {c: ref(c).cast("double") for c in names}
    present = {c: F.when(~is_missing(quoted(c), df.schema[c].dataType), d) for c, d in doubles.items()}
    moments = df.groupBy(key).agg(
        *[
            F.struct(
                F.bround(F.avg(v), 2).alias("mean"),
                F.bround(F.min(v), 2).alias("min"),
                F.bround(F.max(v), 2).alias("max"),
            ).alias(f"__m{j}")
            for j, v in enumerate(present.values())
        ]
    )
    moments = unpivot_as(moments, {c: F.col(f"__m{j}") for j, c in enumerate(names)}, [source], "m")
    medians = grouped_quantiles(df, doubles, [0.5], [source]).select(
        key, "column_name", F.bround(F.get("q", F.lit(0)), 2).alias("median")
    )
    return group_join(moments, medians, [source], on=["column_name"]).select(
        key, "column_name", "m.mean", "median", "m.min", "m.max"
    )


def top_categories(df: DataFrame, group: str, n: int = TOP_CATEGORIES) -> DataFrame:
    """The ``n`` most frequent values of ``group`` with their ``count``; ties by value."""
    present = ~is_missing(quoted(group), df.schema[group].dataType)
    return (
        df.filter(present)
        .groupBy(ref(group))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), ref(group))
        .limit(n)
    )


def category_levels(df: DataFrame, group: str, top: int = TOP_CATEGORIES) -> list:
    """The categories a cross tabulation shows: all in order, or the ``top`` most frequent."""
    rows = top_categories(df, group, top + 1).collect()
    if len(rows) > top:
        return [r[0] for r in rows[:top]]
    return sorted(r[0] for r in rows)


def crosstab_counts(
    df: DataFrame,
    group: str,
    source: str = SOURCE,
    top: int = TOP_CATEGORIES,
    levels: Sequence | DataFrame | None = None,
) -> DataFrame:
    """Sources by category values, counts, absent pairs 0; null categories are ignored.

    The column list is explicit: ``levels`` (a table of them is read, as each becomes a column), or the
    at most ``top`` categories found first.
    """
    if isinstance(levels, DataFrame):
        levels = sorted(r[0] for r in levels.collect())
    levels = list(levels) if levels is not None else category_levels(df, group, top)
    present = ~is_missing(quoted(group), df.schema[group].dataType)
    pairs = df.filter(present).groupBy(ref(source), ref(group)).agg(F.count(F.lit(1)).alias("__n"))
    if not levels:
        return pairs.select(ref(source))
    wide = pairs.groupBy(ref(source)).pivot(group, levels).agg(F.sum("__n"))
    return wide.na.fill(0)


def crosstab_long(
    df: DataFrame,
    group: str,
    source: str = SOURCE,
    top: int = TOP_CATEGORIES,
    levels: Sequence | DataFrame | None = None,
) -> DataFrame:
    """The cross tabulation as ``source``, ``category``, ``count`` rows, absent pairs included.

    ``levels`` as a table may be of any size: it is joined, pairs that do not occur have no row, and a level
    that no source has comes with a null source and count 0.
    """
    if isinstance(levels, DataFrame):
        known = levels.select(F.col(levels.columns[0]).alias("category")).distinct()
        pairs = df.groupBy(ref(source), ref(group).cast("string").alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
        joined = known.join(pairs, F.col("category") == F.col("__of"), "left")
        return joined.select(ref(source), "category", F.coalesce("__n", F.lit(0)).cast("long").alias("count"))
    wide = crosstab_counts(df, group, source, top, levels)
    names = [c for c in wide.columns if c != source]
    return unpivot_as(wide, {c: ref(c) for c in names}, [source], "count").withColumnRenamed(
        "column_name", "category"
    )


def table_profile(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, share of nulls, first five values, unique count."""
    names = [c for c in df.columns if c not in (order_by or ())]
    listing = local_table(
        df.sparkSession,
        [(i, c, df.schema[c].dataType.simpleString()) for i, c in enumerate(names)],
        "column_index int, column_name string, dtype string",
    )
    texts = df.select(
        *[ref(c).cast("string").alias(c) for c in names], *[ref(o) for o in order_by or ()]
    )
    samples = (
        first_values(texts, names, PROFILE_SAMPLES, order_by, keep_empty=True)
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("__firsts"))
    )
    shown = F.coalesce(F.col("__firsts.value"), F.array().cast("array<string>"))
    return (
        # every side has one row per column; samples are whole texts and not broadcast
        listing.join(F.broadcast(null_percent(df, names)), "column_name")
        .join(F.broadcast(count_distinct(df, names)), "column_name", "left")
        .join(samples, "column_name", "left")
        .fillna(0, ["unique_count"])
        .select("column_index", "column_name", "dtype", "nulls_pct", shown.alias("sample_values"), "unique_count")
    )


def profile_rows(df: DataFrame, order_by: Sequence[str], n: int = PROFILE_ROWS) -> DataFrame:
    """The first rows of a table as JSON text."""
    return rows_as_json(head_n(df, n, order_by))


def transpose_stats(stats: DataFrame, sources: Sequence[str], source: str = SOURCE) -> DataFrame:
    """Metrics as rows and the given sources as columns."""
    metrics = numeric_columns(stats, skip=[source])
    tall = unpivot_as(stats, {m: ref(m).cast("double") for m in metrics}, [source])
    return (
        tall.groupBy(F.col("column_name").alias("metric"))
        .pivot(source, list(sources))
        .agg(F.max("value"))
    )


def top_n_columns_by_sum(wide: DataFrame, n: int, source: str = SOURCE) -> DataFrame:
    """Keep the ``n`` numeric columns with the largest totals, largest first, ties by position."""
    names = numeric_columns(wide, skip=[source])
    if len(names) <= n:
        return wide.select(ref(source), *[ref(c) for c in names])
    row = wide.agg(*[F.sum(ref(c)).alias(f"__s{j}") for j, c in enumerate(names)]).first()
    order = sorted(range(len(names)), key=lambda j: (-(row[f"__s{j}"] or 0), j))[:n]
    return wide.select(ref(source), *[ref(names[j]) for j in order])
