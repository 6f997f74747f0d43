"""Profiles kept for each file of a table and merged: adding a file scans that file only.

The state of a file has one row per column (rows, values present, moments, a sketch of the values for distinct counts
and one for quartiles) and the counts of its values. Counts of equal values add up, so merged answers are those of
one pass over all files: distinct values, quartiles and outliers exact, mean and deviation up to rounding. The counts
grow with the number of distinct values, 8 bytes each for numbers and 64 at most for text; a file saved without them
takes some hundred kilobytes for each column, whatever its size, and answers approximately.

States lie in one table partitioned by file. Saving a file again replaces its state and no other. A file without rows
has columns and no values; a column that a file lacks is null in its rows, as in tables stacked by name. Types may differ
between files among whole numbers, or among whole and floating numbers; other clashes raise ``ValueError``, since
equal values could not be told.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import local_table, numeric_columns, quoted, ref
from ..functions.parsing import is_missing
from .frequencies import comparable, value_frequencies
from .quantiles import SKETCH_SIZE, quantiles_of_shares, sketch_quantiles, sorted_shares
from .statistics import FENCE, QUARTILES, statistics_table

_STATE = {
    "column_index": "int", "column_name": "string", "dtype": "string", "exact": "boolean", "rows": "bigint",
    "present": "bigint", "mean": "double", "spread": "double", "low": "double", "high": "double",
    "value_sketch": "binary", "rank_sketch": "binary", "num": "double", "txt": "string", "cnt": "bigint", "file": "string",
}
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_FLOATING = ("float", "double")
_EDGES = ["q1", "median", "q3"]
# Size of the sketches of values: distinct counts are off by about 1 %.
_LG_VALUES = 14


def _value_text(data_type: T.DataType) -> Column | None:
    """A counted value as the text that ``comparable`` gives for it, where its count tells that."""
    num, txt = F.col("num"), F.col("txt")
    whole = F.coalesce(txt.try_cast("bigint"), num.cast("bigint"))
    if isinstance(data_type, (T.StringType, T.DecimalType)):
        return txt
    if data_type.simpleString() in _WHOLE:
        return whole.cast("string")
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.BooleanType)):
        return num.cast(data_type).cast("string")
    if isinstance(data_type, T.DateType):
        return F.date_from_unix_date(num.cast("int")).cast("string")
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", whole, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("string")
    return None


def _facts(df: DataFrame, counts: DataFrame | None) -> DataFrame:
    """One row per column of a file.

    Moments and sketches are two aggregates: plain sums run in generated code only while no sketch is among them. Where
    values are counted, each is added to the sketch of its column once, instead of once per row.
    """
    numeric = numeric_columns(df)
    told, sketched, wide, texts, again = [], [], [], [], {}
    for j, f in enumerate(df.schema.fields):
        value = F.when(~is_missing(quoted(f.name), f.dataType), ref(f.name))
        number = (value.cast("double") if f.name in numeric else F.lit(None).cast("double")).alias(f"__p{j}")
        wide += [F.when(value.isNotNull(), 1).alias(f"__v{j}"), number]
        facts = {
            "column_index": F.lit(j), "column_name": F.lit(f.name), "dtype": F.lit(f.dataType.simpleString()),
            "exact": F.lit(counts is not None), "rows": F.count(F.lit(1)), "present": F.count(f"__v{j}"), "mean": F.avg(f"__p{j}"),
            "spread": F.var_pop(f"__p{j}") * F.count(f"__p{j}"), "low": F.min(f"__p{j}"), "high": F.max(f"__p{j}"),
        }
        told.append(F.struct(*[v.alias(n) for n, v in facts.items()]))
        text = None if counts is None else _value_text(f.dataType)
        if text is not None:
            again[f.name] = text
        texts += [comparable(value, f.dataType).cast("string").alias(f"__t{j}"), number]
        values = F.hll_sketch_agg(f"__t{j}", F.lit(_LG_VALUES)) if text is None else F.lit(None).cast("binary")
        ranks = F.expr(f"kll_sketch_agg_double(__p{j}, {SKETCH_SIZE})") if f.name in numeric else F.lit(None).cast("binary")
        sketched.append(F.struct(F.lit(j).alias("column_index"), values.alias("value_sketch"), ranks.alias("rank_sketch")))
    moments = df.select(*wide).agg(F.array(*told).alias("facts")).select(F.inline("facts"))
    sketches = df.select(*texts).agg(F.array(*sketched).alias("facts")).select(F.inline("facts"))
    # one row per column on every side
    out = moments.join(F.broadcast(sketches), "column_index")
    if not again:
        return out
    # asked for here as well, the counts come from the same shuffle as those that are saved
    asked = counts.filter(F.col("cnt") > 0)
    text = reduce(lambda rest, c: F.when(F.col("column_name") == c, again[c]).otherwise(rest), again, F.lit(None).cast("string"))
    counted = asked.select("column_name", text.alias("__text")).groupBy("column_name").agg(
        F.hll_sketch_agg("__text", F.lit(_LG_VALUES)).alias("__counted")
    )
    out = out.join(F.broadcast(counted), "column_name", "left")
    return out.withColumn("value_sketch", F.coalesce("value_sketch", "__counted")).drop("__counted")


def save_profile(df: DataFrame, path: str, file: str, exact: bool = True) -> None:
    """Save the state of one file under its name, in place of an earlier one; without ``exact`` sketches only."""
    counts = value_frequencies(df) if exact else None
    state = _facts(df, counts)
    if exact:
        state = state.unionByName(counts, allowMissingColumns=True)
    named = state.withColumn("file", F.lit(file))
    missing = {n: F.lit(None).cast(t) for n, t in _STATE.items() if n not in named.columns}
    writer = named.withColumns(missing).select(*_STATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "zstd").partitionBy("file").parquet(path)


def _merged_type(column: str, found: Sequence[str]) -> str:
    if len(found) == 1:
        return found[0]
    if all(t in _WHOLE for t in found):
        return max(found, key=_WHOLE.index)
    if all(t in _WHOLE + _FLOATING for t in found):
        return "double"
    raise ValueError(f"types of {column!r} differ between files: {', '.join(sorted(found))}")


def _moments(listing: DataFrame) -> DataFrame:
    """Count, mean, deviation and extremes of each column; deviations of the files are taken from the common mean."""
    n = F.sum("present")
    centre = listing.groupBy("column_name").agg((F.sum(F.col("present") * F.col("mean")) / F.nullif(n, F.lit(0))).alias("centre"))
    # one row per column
    both = listing.join(F.broadcast(centre.withColumnRenamed("column_name", "c")), F.col("column_name") == F.col("c"))
    away = F.col("mean") - F.col("centre")
    total = F.sum(F.col("spread") + F.col("present") * away * away)
    return both.groupBy("column_name").agg(
        n.alias("non_null_count"), F.first("centre").alias("mean"), F.min("low").alias("min"), F.max("high").alias("max"),
        F.when(n > 1, F.sqrt(total / (n - 1))).alias("std"),
    )


def merged_statistics(spark: SparkSession, path: str, files: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """``column_statistics`` of all files (or those named) stacked by name, from their states alone.

    Columns come in the order in which the files, by name, bring them in. With ``approx`` no counts of values are
    read: quartiles are off by less than 0.1 % of the rows, distinct counts by about 1 %, and outliers, which no sketch
    holds, are null.
    """
    states = spark.read.schema(", ".join(f"{n} {t}" for n, t in _STATE.items())).parquet(path)
    if files is not None:
        states = states.filter(F.col("file").isin(list(files)))
    listing = states.filter("rows IS NOT NULL")
    # one row per column, and one number
    first = F.min(F.struct("file", "column_index")).alias("first")
    found = listing.groupBy("column_name").agg(first, F.collect_set("dtype").alias("types"), F.min("exact").alias("exact")).collect()
    total = listing.groupBy("file").agg(F.max("rows").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not approx and not all(r.exact for r in found):
        raise ValueError("some files were saved without counts of values; ask for approx")
    found.sort(key=lambda r: tuple(r.first))
    types = {r.column_name: _merged_type(r.column_name, r.types) for r in found}
    numbers = (*_WHOLE, *_FLOATING)
    numeric = [c for c, t in types.items() if t in numbers or t.startswith("decimal")]
    rows = [(i, c, t, c in numeric) for i, (c, t) in enumerate(types.items())]
    columns = local_table(spark, rows, "column_index int, column_name string, dtype string, is_numeric boolean")
    if approx:
        ranks = f"kll_merge_agg_double(rank_sketch, {SKETCH_SIZE})"
        told = listing.groupBy("column_name").agg(
            F.hll_sketch_estimate(F.hll_union_agg("value_sketch", F.lit(True))).alias("unique_count"), F.expr(ranks).alias("merged"),
        )
        quartiles = F.expr(sketch_quantiles("rank", QUARTILES, merged=True)).alias("q")
        told = told.withColumn("rank", F.when(F.col("column_name").isin(numeric), F.col("merged")))
        told = told.select("column_name", "unique_count", quartiles, F.lit(None).cast("bigint").alias("__outliers"))
    else:
        told = _exact(states, numeric)
    # each side has one row per column
    out = columns.join(F.broadcast(_moments(listing)), "column_name").join(F.broadcast(told), "column_name", "left")
    out = out.withColumns({"null_count": F.lit(total) - F.col("non_null_count"), "unique_count": F.coalesce("unique_count", F.lit(0))})
    zero = F.lit(None).cast("bigint") if approx else F.lit(0).cast("bigint")
    outliers = F.when(F.col("is_numeric"), F.coalesce("__outliers", zero)).otherwise(0)
    return statistics_table(out.withColumns({"median": F.get("q", F.lit(1)), "__outliers": outliers}))


def _exact(states: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Distinct values, quartiles and outliers of each column from the counts of values, which are added up once and
    kept in order of the values."""
    value = ["column_name", "num", "txt"]
    tasks = int(states.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = states.filter("cnt IS NOT NULL").select(*value, "cnt").repartitionByRange(tasks, *value)
    counts = sorted_shares(ordered.groupBy(*value).agg(F.sum("cnt").alias("cnt")))
    numbers = counts.filter(F.col("num").isNotNull() & F.col("column_name").isin(list(numeric)))
    q = quantiles_of_shares(numbers.withColumnRenamed("num", "at").drop("txt"), ["column_name"], QUARTILES)
    fences = q.select(F.col("column_name").alias("c"), "q", *[F.get("q", F.lit(i)).alias(e) for i, e in enumerate(_EDGES)])
    reach = (F.col("q3") - F.col("q1")) * FENCE
    # one row per column
    beside = counts.join(F.broadcast(fences), F.col("column_name") == F.col("c"), "left")
    outside = (F.col("num") < F.col("q1") - reach) | (F.col("num") > F.col("q3") + reach)
    present = F.col("num").isNotNull() | F.col("txt").isNotNull()
    return beside.groupBy("column_name").agg(
        F.count_if(present).alias("unique_count"), F.first("q").alias("q"),
        F.coalesce(F.sum(F.when(outside, F.col("cnt"))), F.lit(0)).alias("__outliers"),
    )
