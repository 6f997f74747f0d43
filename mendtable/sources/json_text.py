"""JSON in and out of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import quoted, ref
from ..functions.parsing import iso_format, strip_sql

FENCE = "```"
LANGUAGE = "json"


def fenced_json(text: str) -> Column:
    """The JSON a text holds, as text: the first piece between fence marks that parses, else the
    whole text if that parses, else null. A leading language word is dropped."""
    bare = strip_sql("x")
    rest = strip_sql(f"substr({bare}, {len(LANGUAGE) + 1})")
    clean = f"transform(split({text}, '{FENCE}'), x -> CASE WHEN startswith({bare}, '{LANGUAGE}') THEN {rest} ELSE {bare} END)"
    pieces = f"filter({clean}, x -> try_parse_json(x) IS NOT NULL)"
    whole = f"CASE WHEN try_parse_json({text}) IS NOT NULL THEN {text} END"
    return F.expr(
        f"CASE WHEN contains({text}, '{FENCE}') THEN coalesce(get({pieces}, 0), {whole}) ELSE {whole} END"
    )


def extract_fenced_json(
    df: DataFrame, column: str, schema: str | T.DataType | None = None, out: str = "json"
) -> DataFrame:
    """Add the JSON found in a text column, as text, or as typed values when given a schema."""
    found = fenced_json(quoted(column))
    return df.withColumn(out, found if schema is None else F.from_json(found, schema))


def _plain(c: Column, t: T.DataType) -> Column:
    """A value as JSON shows it, nested ones included: moments in ISO form, NaN as null."""
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return iso_format(c)
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _plain(x, t.elementType))
    if isinstance(t, T.MapType):
        return F.transform_values(c, lambda _, x: _plain(x, t.valueType))
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_plain(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
    return c


def rows_as_json(df: DataFrame, out: str = "row_json") -> DataFrame:
    """Each row as one JSON text; timestamps in ISO form, missing values as null."""
    columns = [_plain(ref(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias(out))
