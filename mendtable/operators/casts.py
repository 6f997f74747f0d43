"""Casting text columns to their semantic types; values that do not parse become null."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import quoted, ref
from ..functions.parsing import (
    all_integers_sql,
    strip_currency_sql,
    to_boolean,
    to_datetime,
    to_integer,
    to_number,
)

# Type names the caster accepts besides the inferred ones.
ALIASES = {"category": "categorical", "string": "text"}
CAST_TYPES = [
    "integer", "float", "boolean", "datetime", "categorical", "currency", "text", "identifier",
]


def cast_integer(v: str) -> Column:
    return to_integer(v)


def cast_float(v: str) -> Column:
    return to_number(v)


def cast_boolean(v: str) -> Column:
    return to_boolean(v)


def cast_datetime(v: str) -> Column:
    return to_datetime(v)


def cast_currency(v: str, decimal: bool = False) -> Column:
    """Money text to double, or to an exact decimal with two places."""
    if decimal:
        return F.expr(f"try_cast({strip_currency_sql(v)} AS DECIMAL(18, 2))")
    return to_number(strip_currency_sql(v))


def cast_text(v: str) -> Column:
    return F.expr(f"CAST({v} AS STRING)")


# The message each cast logs.
_PARSERS = {
    "integer": (cast_integer, "Converted '{}' to integer"),
    "float": (cast_float, "Converted '{}' to float"),
    "boolean": (cast_boolean, "Converted '{}' to boolean"),
    "datetime": (cast_datetime, "Converted '{}' to datetime"),
    "categorical": (cast_text, "Converted '{}' to categorical"),
    "currency": (cast_currency, "Converted '{}' to numeric (currency symbols removed)"),
    "text": (cast_text, "Converted '{}' to string"),
    "identifier": (cast_text, "Kept '{}' as identifier (string)"),
}


@dataclass(frozen=True)
class CastStep:
    """What happens to one column: ``target`` is None when the column stays as it is."""

    column: str
    target: str | None
    message: str


def _text(df: DataFrame, c: str) -> str:
    plain = isinstance(df.schema[c].dataType, T.StringType)
    return quoted(c) if plain else f"CAST({quoted(c)} AS STRING)"


def integral_columns(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """Text columns whose every parsed number is a 64-bit integer; one scan, one row of flags."""
    if not columns:
        return set()
    flags = [F.expr(all_integers_sql(_text(df, c))).alias(f"f{j}") for j, c in enumerate(columns)]
    row = df.agg(*flags).first()
    return {c for j, c in enumerate(columns) if row[f"f{j}"]}


def plan_casts(
    df: DataFrame, types: dict[str, str], integral: set[str] | None = None
) -> list[CastStep]:
    """Decide every column's cast. The integer cast is all or nothing per column.

    ``integral`` names columns already known to hold only integers; None looks at the data.
    """
    wanted = {c: ALIASES.get(t, t) for c, t in types.items()}
    if integral is None:
        integral = integral_columns(
            df, [c for c, t in wanted.items() if t == "integer" and c in df.columns]
        )
    steps = []
    for c, t in wanted.items():
        if c not in df.columns:
            steps.append(CastStep(c, None, f"ERROR: Column '{c}' not found"))
        elif t not in _PARSERS:
            steps.append(CastStep(c, None, f"Unknown type '{types[c]}' - no transformation applied"))
        elif t == "integer" and c not in integral:
            steps.append(
                CastStep(c, None, f"ERROR transforming '{c}': not every number is an integer")
            )
        else:
            steps.append(CastStep(c, t, _PARSERS[t][1].format(c)))
    return steps


def parsed_column(df: DataFrame, column: str, target: str) -> Column:
    """A column read as its semantic type."""
    return _PARSERS[target][0](_text(df, column))


def run_casts(df: DataFrame, steps: Sequence[CastStep]) -> DataFrame:
    """Apply all decided casts in one projection."""
    targets = {s.column: s.target for s in steps if s.target}
    out = []
    for c in df.columns:
        target = targets.get(c)
        if target is None:
            out.append(ref(c))
            continue
        parsed = _PARSERS[target][0](_text(df, c))
        marked = target in ("categorical", "identifier")
        out.append(parsed.alias(c, metadata={"semantic_type": target}) if marked else parsed.alias(c))
    return df.select(*out)


def apply_casts(
    df: DataFrame, types: dict[str, str], integral: set[str] | None = None
) -> DataFrame:
    """Cast each column to its semantic type; unknown columns and types are left alone."""
    return run_casts(df, plan_casts(df, types, integral))
