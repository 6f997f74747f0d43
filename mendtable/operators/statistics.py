"""Column statistics, quartile fences and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import broadcast_if_small, group_join, local_table, numeric_columns, quoted, ref, unpivot_as
from ..functions.parsing import is_missing
from .frequencies import value_frequencies
from .quantiles import grouped_quantiles, sketch_quantiles, table_quantiles

# The quartiles, and the fence distance in interquartile ranges.
QUARTILES = [0.25, 0.5, 0.75]
FENCE = 1.5

_MOMENTS = {"min": "min({})", "max": "max({})", "mean": "avg({})", "std": "stddev_samp({})"}


def _doubles(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {c: ref(c).cast("double") for c in columns}


def _present(df: DataFrame, c: str) -> Column:
    return F.when(~is_missing(quoted(c), df.schema[c].dataType), ref(c).cast("double"))


def _with_fences(facts: DataFrame) -> DataFrame:
    iqr = F.col("q3") - F.col("q1")
    return facts.withColumns(
        {
            "iqr": iqr,
            "lower": F.col("q1") - F.lit(FENCE) * iqr,
            "upper": F.col("q3") + F.lit(FENCE) * iqr,
        }
    )


def _numeric_facts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Quartiles and moments per numeric column (and group)."""
    spark = df.sparkSession
    if not by:
        found, _ = table_quantiles(df, _doubles(df, columns), QUARTILES)
        rows = [(c, *(found[c] or [None] * 3)) for c in columns]
        q = local_table(spark, rows, "column_name string, q1 double, median double, q3 double")
        moments = unpivot_as(
            df.select(*[_present(df, c).alias(f"__p{j}") for j, c in enumerate(columns)]).agg(
                *[
                    F.struct(*[F.expr(text.format(f"__p{j}")).alias(name) for name, text in _MOMENTS.items()]).alias(f"__m{j}")
                    for j in range(len(columns))
                ]
            ),
            {c: F.col(f"__m{j}") for j, c in enumerate(columns)},
            (),
            "m",
        )
        # one row per column on either side
        return q.join(F.broadcast(moments), "column_name").select("column_name", "q1", "median", "q3", "m.*")
    keys = [ref(b) for b in by]
    q = grouped_quantiles(df, _doubles(df, columns), QUARTILES, by).select(
        *keys,
        "column_name",
        *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(["q1", "median", "q3"])],
    )
    moments = (
        unpivot_as(df, {c: _present(df, c) for c in columns}, by)
        .groupBy(*keys, "column_name")
        .agg(*[F.expr(text.format("value")).alias(name) for name, text in _MOMENTS.items()])
    )
    return group_join(q, moments, by, on=["column_name"])


def quartiles_iqr(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """``q1``, ``q3``, ``iqr`` and both fences per numeric column (and group).

    Exact by default. With ``approx`` quartiles are values of nearly the wanted rank (off by less
    than 0.1 % of the rows), from one pass that shuffles sketches only.
    """
    columns = list(columns or numeric_columns(df, skip=by))
    keys = [ref(b) for b in by]
    names = ["q1", "median", "q3"]
    if approx:
        doubles = df.select(*keys, *[_present(df, c).alias(f"__p{j}") for j, c in enumerate(columns)])
        made = doubles.groupBy(*keys).agg(
            *[F.expr(sketch_quantiles(f"__p{j}", QUARTILES)).alias(f"__q{j}") for j in range(len(columns))]
        )
        tall = unpivot_as(made, {c: F.col(f"__q{j}") for j, c in enumerate(columns)}, by, "q")
        return _with_fences(tall.select(*keys, "column_name", *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(names)]))
    if by:
        q = grouped_quantiles(df, _doubles(df, columns), QUARTILES, by).select(
            *keys,
            "column_name",
            *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(["q1", "median", "q3"])],
        )
    else:
        found, _ = table_quantiles(df, _doubles(df, columns), QUARTILES)
        q = local_table(
            df.sparkSession,
            [(c, *(found[c] or [None] * 3)) for c in columns],
            "column_name string, q1 double, median double, q3 double",
        )
    return _with_fences(q)


def fences(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float] | None]:
    """Outlier fences of whole columns as plain numbers; None for a column without values."""
    found, _ = table_quantiles(df, _doubles(df, columns), [0.25, 0.75])
    out: dict[str, tuple[float, float] | None] = {}
    for c, q in found.items():
        reach = FENCE * (q[1] - q[0]) if q else 0.0
        out[c] = (q[0] - reach, q[1] + reach) if q else None
    return out


def iqr_outlier_rows(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose value lies outside the fences of the column (of its group).

    Without ``by`` the fences are literals, so the filter reaches the scan.
    """
    v = ref(column)
    present = ~is_missing(quoted(column), df.schema[column].dataType)
    if not by:
        ends = fences(df, [column])[column]
        if ends is None:
            return df.filter(F.lit(False))
        return df.filter(present & ((v < F.lit(ends[0])) | (v > F.lit(ends[1]))))
    limits = quartiles_iqr(df, [column], by).select(
        *[ref(b).alias(f"__by{i}") for i, b in enumerate(by)],
        F.col("lower").alias("__lower"),
        F.col("upper").alias("__upper"),
    )
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & ref(b).eqNullSafe(F.col(f"__by{i}"))
    rows = df.join(broadcast_if_small(limits), same)
    outside = present & ((v < F.col("__lower")) | (v > F.col("__upper")))
    return rows.filter(outside).select(*[ref(c) for c in df.columns])


def outlier_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name``, ``outlier_count``, ``has_outliers`` per numeric column."""
    columns = list(columns or numeric_columns(df))
    ends = fences(df, columns)
    counts = df.agg(
        *[
            (
                F.count_if(_present(df, c) < ends[c][0]) + F.count_if(_present(df, c) > ends[c][1])
                if ends[c]
                else F.lit(None).cast("long")
            ).alias(f"__n{j}")
            for j, c in enumerate(columns)
        ]
    )
    tall = unpivot_as(
        counts, {c: F.col(f"__n{j}") for j, c in enumerate(columns)}, (), "outlier_count"
    )
    return tall.withColumn("has_outliers", F.col("outlier_count") > 0)


_SHOWN = ["min", "max", "median", "mean", "std"]


def _approximate_statistics(df: DataFrame, names: list[str], numeric: list[str], by: Sequence[str]) -> DataFrame:
    """Column statistics from two aggregates that shuffle sketches and numbers only: the first has quartiles, moments
    and distinct counts, the second counts what lies outside the fences of the first."""
    keys = [ref(b) for b in by]
    missing = {c: is_missing(quoted(c), df.schema[c].dataType) for c in names}
    values = {c: F.when(~missing[c], ref(c)) for c in names}
    wide = df.select(
        *keys, *[v.alias(f"__v{j}") for j, v in enumerate(values.values())],
        *[_present(df, c).alias(f"__p{names.index(c)}") for c in numeric],
    )
    parts = []
    for j, c in enumerate(names):
        value = F.col(f"__v{j}")
        told = {"non_null_count": F.count(value), "null_count": F.count_if(value.isNull()), "unique_count": F.approx_count_distinct(value, 0.01)}
        for name, text in _MOMENTS.items():
            told[name] = F.expr(text.format(f"__p{j}")) if c in numeric else F.lit(None).cast("double")
        told["q"] = F.expr(sketch_quantiles(f"__p{j}", QUARTILES)) if c in numeric else F.lit(None).cast("array<double>")
        parts.append(F.struct(*[v.alias(n) for n, v in told.items()]).alias(f"__f{j}"))
    facts = wide.groupBy(*keys).agg(*parts)
    tall = unpivot_as(facts, {c: F.col(f"__f{j}") for j, c in enumerate(names)}, by, "f")
    quartiles = [F.get("f.q", F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    tall = _with_fences(tall.select(*keys, "column_name", "f.*", *quartiles).drop("q"))
    if not numeric:
        return tall.withColumn("__outliers", F.lit(None).cast("long"))
    limits = facts.select(
        *[ref(b).alias(f"__by{i}") for i, b in enumerate(by)],
        *[F.struct(F.get(f"__f{names.index(c)}.q", F.lit(0)).alias("q1"), F.get(f"__f{names.index(c)}.q", F.lit(2)).alias("q3")).alias(f"__l{names.index(c)}") for c in numeric],
    )
    match = F.lit(True)
    for i, b in enumerate(by):
        match = match & ref(b).eqNullSafe(F.col(f"__by{i}"))
    if by:
        rows = wide.join(broadcast_if_small(limits), match)
    else:
        # one row of literals
        (row,) = limits.collect()
        rows = wide.select("*", *[F.struct(F.lit(row[f][0]).cast("double").alias("q1"), F.lit(row[f][1]).cast("double").alias("q3")).alias(f) for f in limits.columns])
    counts = []
    for c in numeric:
        j = names.index(c)
        q1, q3 = F.col(f"__l{j}.q1"), F.col(f"__l{j}.q3")
        reach = (q3 - q1) * FENCE
        outside = (F.col(f"__p{j}") < q1 - reach) | (F.col(f"__p{j}") > q3 + reach)
        counts.append(F.count_if(outside).alias(f"__n{j}"))
    outliers = unpivot_as(rows.groupBy(*keys).agg(*counts), {c: F.col(f"__n{names.index(c)}") for c in numeric}, by, "__outliers")
    return group_join(tall, outliers, by, "left", ["column_name"])


def column_statistics(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """One row per column: type, counts, and for numeric columns moments, median and outliers.

    Quartiles and moments come from one pass of sketches plus a pass over the values around each
    quartile; distinct values and outliers from one frequency shuffle. With ``approx`` nothing but
    sketches is shuffled: quartiles are off by less than 0.1 % of the rows, outliers follow from them,
    and distinct counts have a relative standard deviation of 1 %; all other figures are exact.
    """
    names = [c for c in (columns or df.columns) if c not in by]
    numeric = [c for c in numeric_columns(df) if c in names]
    if approx:
        return _shown(df, _approximate_statistics(df, names, numeric, by), names, numeric, by)
    keys = [ref(b) for b in by]
    spark = df.sparkSession
    listing = local_table(
        spark,
        [(i, c, df.schema[c].dataType.simpleString(), c in numeric) for i, c in enumerate(names)],
        "column_index int, column_name string, dtype string, is_numeric boolean",
    )
    facts = _with_fences(_numeric_facts(df, numeric, by)) if numeric else None
    freq = value_frequencies(df, names, by)
    present = F.col("num").isNotNull() | F.col("txt").isNotNull()
    outside = F.lit(False)
    if facts is not None:
        # without groups the table has one row per numeric column, so broadcasting it is safe
        facts = broadcast_if_small(facts) if by else F.broadcast(facts)
        limits = facts.select(*keys, "column_name", "lower", "upper")
        freq = group_join(freq, limits, by, "left", ["column_name"])
        outside = (F.col("num") < F.col("lower")) | (F.col("num") > F.col("upper"))
    cnt = F.col("cnt")
    counted = freq.groupBy(*keys, "column_name").agg(
        F.coalesce(F.sum(F.when(present, cnt)), F.lit(0)).alias("non_null_count"),
        F.coalesce(F.sum(F.when(~present, cnt)), F.lit(0)).alias("null_count"),
        F.count_if(present).alias("unique_count"),
        F.coalesce(F.sum(F.when(outside, cnt)), F.lit(0)).alias("__outliers"),
    )
    if by:
        out = counted.join(F.broadcast(listing), "column_name")
    else:
        # one row per column on either side
        out = listing.join(F.broadcast(counted), "column_name", "left").fillna(
            0, ["non_null_count", "null_count", "unique_count", "__outliers"]
        )
    if facts is not None:
        out = group_join(out, facts.select(*keys, "column_name", *_SHOWN), by, "left", ["column_name"])
    else:
        out = out.withColumns({s: F.lit(None).cast("double") for s in _SHOWN})
    return statistics_table(out, keys)


def _shown(df: DataFrame, facts: DataFrame, names: list[str], numeric: list[str], by: Sequence[str]) -> DataFrame:
    """Facts with place and type of each column, as ``column_statistics`` has them."""
    listing = local_table(
        df.sparkSession,
        [(i, c, df.schema[c].dataType.simpleString(), c in numeric) for i, c in enumerate(names)],
        "column_index int, column_name string, dtype string, is_numeric boolean",
    )
    counts = F.when(F.col("is_numeric"), F.coalesce("__outliers", F.lit(0))).otherwise(0)
    # one row per column
    return statistics_table(facts.join(F.broadcast(listing), "column_name").withColumn("__outliers", counts), [ref(b) for b in by])


def statistics_table(out: DataFrame, keys: Sequence[Column] = ()) -> DataFrame:
    """The columns of ``column_statistics`` from facts and ``__outliers``; without values there is no outlier count."""
    empty = F.col("is_numeric") & (F.col("non_null_count") == 0)
    outliers = F.when(~empty, F.col("__outliers"))
    return out.select(
        *keys,
        "column_index",
        "column_name",
        "dtype",
        "non_null_count",
        "null_count",
        "unique_count",
        *_SHOWN,
        outliers.alias("outlier_count"),
        (outliers > 0).alias("has_outliers"),
    )


def count_distinct(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """``column_name``, ``unique_count`` of non-null values; the empty string is a value.

    Exact counts shuffle each distinct value once per task. With ``approx`` a sketch of fixed size
    leaves each task instead (HyperLogLog++, 1 % relative standard deviation).
    """
    names = list(columns or df.columns)
    if approx:
        counts = df.agg(
            *[
                F.approx_count_distinct(F.when(~is_missing(quoted(c), df.schema[c].dataType), ref(c)), 0.01).alias(f"__n{j}")
                for j, c in enumerate(names)
            ]
        )
        return unpivot_as(counts, {c: F.col(f"__n{j}") for j, c in enumerate(names)}, (), "unique_count")
    present = F.col("num").isNotNull() | F.col("txt").isNotNull()
    return (
        value_frequencies(df, names)
        .groupBy("column_name")
        .agg(F.count_if(present & (F.col("cnt") > 0)).alias("unique_count"))
    )


def null_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name``, ``nulls_pct`` with one decimal."""
    names = list(columns or df.columns)
    row = df.agg(
        *[
            F.bround(F.avg(is_missing(quoted(c), df.schema[c].dataType).cast("int")) * 100, 1).alias(c)
            for c in names
        ]
    )
    return unpivot_as(row, {c: ref(c) for c in names}, (), "nulls_pct")


def shape(df: DataFrame) -> DataFrame:
    """``row_count`` and ``column_count``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("long")
    )

