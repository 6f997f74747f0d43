"""Value-frequency table and first values per column: the two inputs of every column profile."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref, unpivot_as

# Text up to this many bytes is its own identity; longer text is shuffled as a digest.
WHOLE_TEXT_BYTES = 64


def identity(c: Column) -> Column:
    """Short stand-in for a text value that keeps equality: the text, or its SHA-256 digest.

    A digest is longer than any text kept whole, so the two cannot be confused.
    """
    return F.when(F.octet_length(c) <= WHOLE_TEXT_BYTES, c).otherwise(
        F.concat(F.lit("#"), F.sha2(c, 256))
    )


def comparable(c: Column, data_type: T.DataType) -> Column:
    """A column to group by when only equality matters; values of any size become small."""
    if isinstance(data_type, T.StringType):
        return identity(c)
    if isinstance(data_type, T.BinaryType):
        return F.when(F.octet_length(c) <= WHOLE_TEXT_BYTES, c).otherwise(F.unhex(F.sha2(c, 512)))
    if isinstance(data_type, (T.ArrayType, T.StructType)):
        return F.when(c.isNotNull(), F.sha2(F.to_json(F.struct(c)), 256))
    return c


# Integers up to this size are exact as doubles.
EXACT = 2**53
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_long(c: Column, t: T.DataType) -> Column | None:
    """The value as a bigint that tells values apart, where the type has one."""
    if isinstance(t, (*_WHOLE, T.BooleanType)):
        return c.cast("long")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(t), c)
    return None


def _as_text(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.StringType):
        return identity(c)
    if isinstance(t, T.DecimalType):
        return c.cast("string")
    return F.when(c.isNotNull(), F.sha2(F.to_json(F.struct(c)), 256))


def value_frequencies(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """How often each value occurs: ``by``, ``column_name``, ``num``, ``txt``, ``cnt``.

    ``num`` is the value of a number; ``txt`` tells apart what ``num`` cannot. Values are counted
    map-side, so a hot value leaves each task as one row; integers, moments and floats travel as
    8 bytes, long text as a digest. Nulls (and floating NaN) form one row per column with ``num``
    and ``txt`` both null.
    """
    types = {c: df.schema[c].dataType for c in (columns or df.columns) if c not in by}
    keys = [ref(b) for b in by]
    longs = {c: _as_long(ref(c), t) for c, t in types.items() if _as_long(ref(c), t) is not None}
    floats = {
        c: F.nullif(ref(c).cast("double"), F.lit(float("nan")))
        for c, t in types.items()
        if isinstance(t, (T.DoubleType, T.FloatType))
    }
    texts = {c: _as_text(ref(c), t) for c, t in types.items() if c not in longs and c not in floats}
    decimals = [c for c in texts if isinstance(types[c], T.DecimalType)]

    def counted(values: dict[str, Column]) -> DataFrame:
        tall = unpivot_as(df, values, by)
        return tall.groupBy(*keys, "column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))

    v, parts = F.col("value"), []
    if longs:
        large = F.when(~v.between(-EXACT, EXACT), v.cast("string"))
        parts.append((counted(longs), v.cast("double"), large))
    if floats:
        parts.append((counted(floats), v, F.lit(None).cast("string")))
    if texts:
        number = F.when(F.col("column_name").isin(decimals), v.try_cast("double")) if decimals else F.lit(None)
        parts.append((counted(texts), number.cast("double"), v))
    return reduce(
        lambda a, b: a.unionAll(b),
        [t.select(*keys, "column_name", num.alias("num"), txt.alias("txt"), "cnt") for t, num, txt in parts],
    )


def text_frequencies(
    df: DataFrame, columns: Sequence[str], flags: dict[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Frequencies of text values: ``by``, ``column_name``, ``token``, the ``flags``, ``cnt``.

    ``flags`` maps a name to a SQL expression over the text ``value``. For long text, whose digest
    alone is shuffled, the flags are computed before the shuffle; for short text after it, once
    per distinct value. Null text counts as empty.
    """
    keys = [ref(b) for b in by]
    values = {c: F.coalesce(ref(c), F.lit("")) for c in columns}
    whole = f"octet_length(value) <= {WHOLE_TEXT_BYTES}"
    early = [
        F.expr(f"CASE WHEN NOT {whole} THEN {flag} END AS {name}") for name, flag in flags.items()
    ]
    counted = (
        unpivot_as(df, values, by)
        .select(*keys, "column_name", identity(F.col("value")).alias("value"), *early)
        .groupBy(*keys, "column_name", "value", *flags)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    late = [
        F.expr(f"CASE WHEN {whole} THEN {flag} ELSE {name} END AS {name}")
        for name, flag in flags.items()
    ]
    return counted.select(*keys, "column_name", F.col("value").alias("token"), "cnt", *late)


def first_values(
    df: DataFrame,
    columns: Sequence[str],
    n: int,
    order_by: Sequence[str] | None = None,
    by: Sequence[str] = (),
    keep_empty: bool = False,
) -> DataFrame:
    """The first ``n`` present text values of each column: ``by``, ``column_name``, ``place``, ``value``.

    Rows are ordered by ``order_by``, by default by a digest of the value, since a distributed
    table has no row order. All columns are read in one scan, and each task keeps ``n`` rows per
    group and column before the shuffle.
    """
    keys = [ref(b) for b in by]
    present = F.col("value").isNotNull() if keep_empty else F.col("value") != ""
    order = [F.col(f"__order{i}") for i in range(len(order_by or ()))]
    carried = [ref(o).alias(f"__order{i}") for i, o in enumerate(order_by or ())]
    ranking = [*order, F.md5("value"), F.col("value")] if not order else [*order, F.col("value")]
    wide = df.select(*keys, *carried, *[ref(c).alias(f"__v{j}") for j, c in enumerate(columns)])
    tall = unpivot_as(
        wide,
        {c: F.col(f"__v{j}") for j, c in enumerate(columns)},
        [*by, *[f"__order{i}" for i in range(len(order))]],
    ).filter(present)
    w = Window.partitionBy(*keys, "column_name").orderBy(*ranking)
    placed = tall.withColumn("place", F.row_number().over(w))
    return placed.filter(F.col("place") <= n).select(*keys, "column_name", "place", "value")
