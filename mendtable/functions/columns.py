"""Small helpers over DataFrame schemas and size-checked side tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side table with at most this many rows and bytes may be broadcast.
BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 16 << 20


def quoted(name: str) -> str:
    """A column name as SQL text, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Reference a column by its exact name."""
    return F.col(quoted(name))


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def text_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def unused_name(df: DataFrame, wanted: str) -> str:
    """A column name that does not clash with any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A few driver rows as a table whose size the optimizer knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    types = [_arrow_type(f.dataType) for f in schema.fields]
    if not rows or any(t is None for t in types):
        return spark.createDataFrame(rows, schema)
    columns = list(zip(*rows))
    arrays = [pa.array(values, t) for values, t in zip(columns, types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema.names))


def _arrow_type(t: T.DataType) -> pa.DataType | None:
    if isinstance(t, T.ArrayType):
        inner = _arrow_type(t.elementType)
        return None if inner is None else pa.list_(inner)
    simple = {
        T.StringType: pa.string(), T.DoubleType: pa.float64(), T.LongType: pa.int64(),
        T.IntegerType: pa.int32(), T.BooleanType: pa.bool_(),
    }
    return simple.get(type(t))


def _variable_bytes(df: DataFrame) -> Column | None:
    """Bytes of a row's texts, binaries and nested values; None if it has none."""
    out = None
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            n = F.octet_length(ref(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            n = F.octet_length(F.to_json(F.struct(ref(f.name))))
        else:
            continue
        n = F.coalesce(n, F.lit(0)).cast("long")
        out = n if out is None else out + n
    return out


def small_table(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``df`` as a broadcast local table if it holds at most ``max_rows`` rows and ``max_bytes`` bytes
    of values of variable size, else None.

    Bytes are summed by Spark first, so what is too large never reaches the driver; at most
    ``max_rows + 1`` rows do.
    """
    head = df.limit(max_rows + 1)
    size = _variable_bytes(df)
    if size is not None and (head.agg(F.sum(size)).first()[0] or 0) > max_bytes:
        return None
    rows = head.toArrow()
    if rows.num_rows > max_rows:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` after checking its size; a larger frame is returned without a hint, so the
    join shuffles both sides and adaptive execution splits hot keys."""
    small = small_table(df, max_rows)
    return df if small is None else small


def group_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner", on: Sequence[str] = ()
) -> DataFrame:
    """Join on group keys ``by`` (and ``on``) that come out once; a null or NaN key equals itself."""
    names = {n: unused_name(left, f"__right{i}") for i, n in enumerate([*by, *on])}
    side, same = right, F.lit(True)
    for n, other in names.items():
        side = side.withColumnRenamed(n, other)
        same = same & ref(n).eqNullSafe(ref(other))
    joined = left.join(side, same, how)
    if how == "full":
        joined = joined.withColumns({n: F.coalesce(ref(n), ref(other)) for n, other in names.items()})
    return joined.drop(*names.values())


def unpivot_as(
    df: DataFrame, values: dict[str, Column], by: Sequence[str] = (), value_name: str = "value"
) -> DataFrame:
    """One row per (input row, name) with columns ``by``, ``column_name`` and ``value_name``.

    All values must share one type. The result is an ``Expand``, which stays inside codegen.
    """
    ids = [ref(b) for b in by]
    wide = df.select(*ids, *[v.alias(n) for n, v in values.items()])
    if len(values) == 1:
        (name,) = values
        return wide.select(*ids, F.lit(name).alias("column_name"), ref(name).alias(value_name))
    return wide.unpivot(ids, [ref(n) for n in values], "column_name", value_name)
