"""Missing values: report, fit of fill values, and repair in one projection and one filter."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import broadcast_if_small, group_join, quoted, ref, unpivot_as, unused_name
from ..functions.parsing import is_nil, percent
from .quantiles import grouped_quantiles, table_quantiles

# The repair actions, and which of them suit which kind of column.
NUMERIC_ACTIONS = ["fill_median", "fill_zero", "drop_rows", "leave_empty"]
OTHER_ACTIONS = ["fill_unknown", "fill_most_common", "drop_rows", "leave_empty"]
ALL_ACTIONS = [
    "fill_median", "fill_zero", "fill_unknown", "fill_most_common", "drop_rows", "leave_empty",
]
UNKNOWN = "Unknown"

TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)
EPOCH = dt.datetime(1970, 1, 1)


def _epoch(t: T.DataType) -> Column:
    text = "1970-01-01 00:00:00" + ("" if isinstance(t, T.TimestampNTZType) else "+00:00")
    return F.lit(text).cast(t)


def _micros(c: Column, t: T.DataType) -> Column:
    """Microseconds since the epoch as a double, exact for every year up to 2255."""
    return F.timestamp_diff("MICROSECOND", _epoch(t), c).cast("double")


def _from_micros(n: Column, t: T.DataType) -> Column:
    return F.timestamp_add("MICROSECOND", n.cast("long"), _epoch(t))


def _moment(x: float, t: T.DataType) -> dt.datetime:
    zone = None if isinstance(t, T.TimestampNTZType) else dt.timezone.utc
    return EPOCH.replace(tzinfo=zone) + dt.timedelta(microseconds=int(x))


def _literal(value: object, t: T.DataType) -> Column:
    """A fill value as a literal; moments go through text, which carries their zone."""
    plain = value.isoformat(" ") if isinstance(value, dt.datetime) else value
    return F.lit(plain).cast(t)


def nil(df: DataFrame, name: str, absent: Mapping[str, Column] | None = None) -> Column:
    """Whether a value is missing; not in rows of tables that do not have the column at all."""
    missing = is_nil(quoted(name), df.schema[name].dataType)
    return missing & ~absent[name] if absent and name in absent else missing


def allowed_actions(data_type: T.DataType) -> list[str]:
    return NUMERIC_ACTIONS if isinstance(data_type, T.NumericType) else OTHER_ACTIONS


def check_actions(df: DataFrame, actions: dict[str, str]) -> None:
    """Raise when an action does not suit its column's kind; absent columns are skipped."""
    for c, action in actions.items():
        if c in df.columns and action not in allowed_actions(df.schema[c].dataType):
            raise ValueError(f"{action!r} does not apply to column {c!r}")


def drop_nil_rows(df: DataFrame, name: str) -> DataFrame:
    return df.filter(~nil(df, name))


def nil_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``column_name``, ``nil_count``, ``nil_percentage``, ``is_numeric``; nil-free columns left out."""
    names = [c for c in df.columns if c not in by]
    keys = [ref(b) for b in by]
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(nil(df, c)).alias(f"__n{j}") for j, c in enumerate(names)],
    )
    facts = {
        c: F.struct(
            F.col(f"__n{j}").alias("nil_count"),
            percent(F.col(f"__n{j}"), F.col("__rows"), 2).alias("nil_percentage"),
            F.lit(isinstance(df.schema[c].dataType, T.NumericType)).alias("is_numeric"),
        )
        for j, c in enumerate(names)
    }
    tall = unpivot_as(counts, facts, by, "fact")
    return tall.select(*keys, "column_name", "fact.*").filter(F.col("nil_count") > 0)


@dataclass(frozen=True)
class NilStep:
    """The repair of one column. ``out_type`` is the column's type afterwards."""

    column: str
    action: str
    nil_count: int
    out_type: T.DataType
    fills: bool
    message: str


@dataclass
class NilFit:
    """Everything a repair needs; ``values`` holds fill values, ``table`` those per group, ``absent`` the rows that
    do not have a column, ``group_rows`` the size of each group where steps are told by group."""

    steps: list[NilStep]
    values: dict[str, object] = field(default_factory=dict)
    by: tuple[str, ...] = ()
    table: DataFrame | None = None
    group_steps: dict[object, list[NilStep]] = field(default_factory=dict)
    absent: Mapping[str, Column] = field(default_factory=dict)
    group_rows: dict[object, int] = field(default_factory=dict)


def _as_number(c: Column, t: T.DataType) -> Column | None:
    """Values whose median exists, as doubles; None for other types."""
    if isinstance(t, T.NumericType):
        return c.cast("double")
    return _micros(c, t) if isinstance(t, TIMESTAMPS) else None


def _mode_pair(c: Column, t: T.DataType) -> Column:
    """Value as struct(num, txt) that sorts like the value and can be turned back into it."""
    num, txt = F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(t, T.StringType):
        txt = c
    elif isinstance(t, TIMESTAMPS):
        num = _micros(c, t)
    elif isinstance(t, T.DateType):
        num = F.unix_date(c).cast("double")
    elif isinstance(t, (T.LongType, T.DecimalType)):
        num, txt = c.cast("double"), c.cast("string")
    else:
        num = c.cast("double")
    return F.struct(num.alias("num"), txt.alias("txt"))


def _from_mode_pair(pair: Column, t: T.DataType) -> Column:
    num, txt = pair["num"], pair["txt"]
    if isinstance(t, T.StringType):
        return txt
    if isinstance(t, TIMESTAMPS):
        return _from_micros(num, t)
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(num.cast("int"))
    if isinstance(t, (T.LongType, T.DecimalType)):
        return txt.cast(t)
    return num.cast(t)


def most_common(
    df: DataFrame, values: dict[str, Column], types: dict[str, T.DataType], by: Sequence[str] = ()
) -> DataFrame:
    """Per column the most frequent non-null value, ties to the smallest: ``by``, ``column_name``,
    ``pair``. Counts are combined map-side and a column's distinct values stay spread over tasks."""
    keys = [ref(b) for b in by]
    pairs = {
        c: F.when(v.isNotNull(), _mode_pair(v, types[c])) for c, v in values.items()
    }
    counted = (
        unpivot_as(df, pairs, by, "pair")
        .filter(F.col("pair").isNotNull())
        .select(*keys, "column_name", "pair.num", "pair.txt")
        .groupBy(*keys, "column_name", "num", "txt")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    best = F.min(F.struct(-F.col("cnt"), F.col("num"), F.col("txt")))
    return counted.groupBy(*keys, "column_name").agg(best.alias("best")).select(
        *keys, "column_name", F.struct(F.col("best.num"), F.col("best.txt")).alias("pair")
    )


def _is_whole(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


# What the log says of each repair.
MESSAGES = {
    "none": "No nil values in '{c}'",
    "drop_rows": "Dropped {n} rows with nil values in '{c}'",
    "leave_empty": "Left {n} nil values in '{c}' unchanged",
    "no_median": "ERROR handling nil values in '{c}': no median of text",
    "fill_median": "Filled {n} nil values in '{c}' with median{shown}{note}",
    "fill_zero": "Filled {n} nil values in '{c}' with 0",
    "fill_unknown": "Filled {n} nil values in '{c}' with '{unknown}'{note}",
    "fill_most_common": "Filled {n} nil values in '{c}' with most common value{shown}",
    "unknown_action": "Unknown action '{action}' for nil value handling",
}


def _plan_step(c: str, t: T.DataType, action: str, n: int, value: object, fractional: bool) -> NilStep:
    """What an action does to a column of this type, and the message it logs."""

    def step(message: str, out: T.DataType | None = None, note: str = "", quote: str = "") -> NilStep:
        shown = "" if value is None else f" ({quote}{value}{quote})"
        said = MESSAGES[message].format(c=c, n=n, action=action, unknown=UNKNOWN, shown=shown, note=note)
        return NilStep(c, action, n, out or t, out is not None, said)

    text = T.StringType()
    if n == 0:
        return step("none")
    if action == "fill_median":
        if _as_number(F.lit(0), t) is None:
            return step("no_median")
        promoted = fractional and _is_whole(t)
        return step(action, T.DoubleType() if promoted else t, ", column promoted to float" * promoted)
    if action == "fill_zero":
        return step(action, t if isinstance(t, (T.NumericType, T.StringType, T.BooleanType)) else text)
    if action == "fill_unknown":
        return step(action, text, "" if isinstance(t, T.StringType) else ", column turned into text")
    if action == "fill_most_common":
        return step(action, text if value == UNKNOWN else t, quote="'")
    return step(action if action in MESSAGES else "unknown_action")


def _constant(action: str, t: T.DataType) -> object:
    if action == "fill_unknown":
        return UNKNOWN
    if isinstance(t, T.NumericType):
        return 0
    return False if isinstance(t, T.BooleanType) else "0"


def stored_fit(df: DataFrame, actions: dict[str, str], fills: dict[str, str]) -> NilFit:
    """The fit that fill values of another table give, without a job: columns change their types as
    if they had nils, so that every table comes out alike."""
    steps, values = [], {}
    for c in df.columns:
        if c not in actions:
            continue
        t, action, value = df.schema[c].dataType, actions[c], fills.get(c)
        if action in ("fill_unknown", "fill_zero"):
            value = _constant(action, t)
        fractional = action == "fill_median" and value is not None and _is_whole(t) and float(value) % 1 != 0
        step = _plan_step(c, t, action, 1, value, fractional)
        if step.fills and value is not None:
            whole = action == "fill_median" and _is_whole(step.out_type)
            values[c] = int(float(value)) if whole and "." in str(value) else value
        steps.append(replace(step, message=f"Applied stored choice '{action}' to nil values in '{c}'"))
    return NilFit(steps, values)


def fit_nils(
    df: DataFrame, actions: dict[str, str], by: Sequence[str] = (), always: bool = False, group_steps: bool = False,
    absent: Mapping[str, Column] | None = None,
) -> NilFit:
    """Fit all fill values at once.

    ``absent`` tells, for columns that some of the stacked tables lack, in which rows that is so.

    ``always`` fits values for columns without nils too. ``group_steps`` tells the steps of every
    group apart, one row per group on the driver; for groups that are as few as input files.

    Columns are repaired in schema order and each ``drop_rows`` hides its rows from later columns.
    Since a fill changes only its own column, column k's statistic equals the statistic over rows
    that no earlier dropped column is nil in, so nothing has to be repaired step by step.
    """
    by = tuple(by)
    names = [c for c in df.columns if c in actions and c not in by]
    if not names:
        return NilFit([], {}, by)
    types = {c: df.schema[c].dataType for c in names}
    alive, alive_at = F.lit(True), {}
    for c in names:
        alive_at[c] = alive
        if actions[c] == "drop_rows":
            alive = alive & ~nil(df, c, absent)
    present = {c: F.when(alive_at[c] & ~nil(df, c), ref(c)) for c in names}
    counted = {c: F.when(alive_at[c] & nil(df, c, absent), F.lit(1)) for c in names}
    medians = {
        c: _as_number(present[c], types[c])
        for c in names
        if actions[c] == "fill_median" and _as_number(present[c], types[c]) is not None
    }
    modes = {c: present[c] for c in names if actions[c] == "fill_most_common"}
    if by:
        return replace(_fit_groups(df, actions, names, types, counted, medians, modes, by, group_steps), absent=absent or {})

    q, counts = table_quantiles(
        df, medians, [0.5], extra={c: (counted[c], "count({})") for c in names}
    )
    values: dict[str, object] = {}
    for c, found in q.items():
        if found:
            values[c] = found[0]
    needed = {c: v for c, v in modes.items() if counts[c] or always}
    if needed:
        typed = most_common(df, needed, types).collect()
        for row in typed:
            values[row["column_name"]] = _mode_value(row["pair"], types[row["column_name"]])
        for c in needed:
            values.setdefault(c, UNKNOWN)
    steps = []
    for c in names:
        action = actions[c]
        fractional = action == "fill_median" and c in values and values[c] != int(values[c])
        if action in ("fill_unknown", "fill_zero"):
            values[c] = _constant(action, types[c])
        step = _plan_step(c, types[c], action, counts[c] or int(always), values.get(c), fractional)
        if not step.fills or c not in values:
            values.pop(c, None)
        elif action == "fill_median":
            values[c] = _median_value(values[c], types[c], step.out_type)
        steps.append(step)
    return NilFit(steps, values)


def _median_value(x: float, t: T.DataType, out: T.DataType) -> object:
    if isinstance(t, TIMESTAMPS):
        return _moment(x, t)
    if isinstance(out, T.DecimalType):
        return decimal.Decimal(repr(x))
    return int(x) if _is_whole(out) else x


def _mode_value(pair, t: T.DataType) -> object:
    if isinstance(t, T.StringType):
        return pair["txt"]
    if isinstance(t, TIMESTAMPS):
        return _moment(pair["num"], t)
    if isinstance(t, T.DateType):
        return dt.date(1970, 1, 1) + dt.timedelta(days=int(pair["num"]))
    if isinstance(t, T.BooleanType):
        return bool(pair["num"])
    if isinstance(t, T.LongType):
        return int(pair["txt"])
    if isinstance(t, T.DecimalType):
        return decimal.Decimal(pair["txt"])
    return int(pair["num"]) if _is_whole(t) else pair["num"]


def _fit_groups(df, actions, names, types, counted, medians, modes, by, group_steps) -> NilFit:
    """Fill values per group, as a table with one row per group and one column per fill."""
    keys = [ref(b) for b in by]
    # a group with nils and without values has no most common value
    by_group = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(counted[c]).alias(f"n{j}") for j, c in enumerate(names)],
        *[F.count(modes[c]).alias(f"v{j}") for j, c in enumerate(names) if c in modes],
    )
    # one row per group is on the driver anyway where every group's steps are asked for
    rows = by_group.collect() if group_steps else []
    if group_steps:
        counts = {c: sum(r[f"n{j}"] for r in rows) for j, c in enumerate(names)}
        unknown = {c for j, c in enumerate(names) if c in modes and any(r[f"n{j}"] and not r[f"v{j}"] for r in rows)}
    else:
        totals = by_group.agg(
            *[F.sum(f"n{j}").alias(f"n{j}") for j in range(len(names))],
            *[
                F.bool_or((F.col(f"n{j}") > 0) & (F.col(f"v{j}") == 0)).alias(f"u{j}")
                for j, c in enumerate(names)
                if c in modes
            ],
        ).first()
        counts = {c: totals[f"n{j}"] or 0 for j, c in enumerate(names)}
        unknown = {c for j, c in enumerate(names) if c in modes and totals[f"u{j}"]}
    tables = []
    medians = {c: v for c, v in medians.items() if counts[c]}
    modes = {c: v for c, v in modes.items() if counts[c]}
    if medians:
        q = grouped_quantiles(df, medians, [0.5], by)
        tables.append(
            q.groupBy(*keys).agg(
                *[
                    F.max(F.when(F.col("column_name") == c, F.get("q", F.lit(0)))).alias(f"__fill_{c}")
                    for c in medians
                ]
            )
        )
    if modes:
        m = most_common(df, modes, types, by)
        picks = [
            F.max(F.when(F.col("column_name") == c, F.col("pair"))).alias(f"__pair_{c}") for c in modes
        ]
        tables.append(
            m.groupBy(*keys).agg(*picks).select(
                *keys,
                *[_from_mode_pair(ref(f"__pair_{c}"), types[c]).alias(f"__fill_{c}") for c in modes],
            )
        )
    table, fractional, found = None, {}, {}
    if tables:
        table = tables[0] if len(tables) == 1 else group_join(tables[0], tables[1], by, "full")
        table = broadcast_if_small(table)
        if group_steps:
            fills = table.collect()
            found = {r[by[0]]: r for r in fills}
            fractional = {c: any(_fraction(r[f"__fill_{c}"]) for r in fills) for c in medians}
        elif medians:
            flags = table.agg(
                *[
                    F.coalesce(F.bool_or(ref(f"__fill_{c}") != F.rint(ref(f"__fill_{c}"))), F.lit(False))
                    .alias(f"f{j}")
                    for j, c in enumerate(medians)
                ]
            ).first()
            fractional = {c: flags[f"f{j}"] for j, c in enumerate(medians)}
    steps, values = [], {}
    for c in names:
        value = UNKNOWN if c in unknown else None
        step = _plan_step(c, types[c], actions[c], counts[c], value, fractional.get(c, False))
        if step.fills and actions[c] in ("fill_unknown", "fill_zero"):
            values[c] = _constant(actions[c], types[c])
        steps.append(step)
    told = {
        r[by[0]]: [_group_step(s, types[s.column], r[f"n{j}"], found.get(r[by[0]])) for j, s in enumerate(steps)] for r in rows
    }
    return NilFit(steps, values, by, table, told, group_rows={r[by[0]]: r["__rows"] for r in rows})


def _fraction(x: float | None) -> bool:
    return x is not None and x != int(x)


def _group_step(s: NilStep, t: T.DataType, n: int, row) -> NilStep:
    """The step of a column in one group, with the group's own count and fill value."""
    name = f"__fill_{s.column}"
    value = row[name] if row is not None and name in row else None
    fractional = s.action == "fill_median" and value is not None and value != int(value)
    if s.action == "fill_most_common" and value is None:
        value = UNKNOWN
    return _plan_step(s.column, t, s.action, n, value, fractional)


def repair_nils(df: DataFrame, fit: NilFit) -> DataFrame:
    """Apply a fit: one filter for all dropped rows and one projection for all fills."""
    out = df
    keep = F.lit(True)
    for s in fit.steps:
        if s.action == "drop_rows" and s.nil_count and s.column in df.columns:
            keep = keep & ~nil(df, s.column, fit.absent)
    if any(s.action == "drop_rows" and s.nil_count for s in fit.steps):
        out = out.filter(keep)
    if fit.table is not None:
        names = {b: unused_name(out, f"__by{i}") for i, b in enumerate(fit.by)}
        side = fit.table
        for b, n in names.items():
            side = side.withColumnRenamed(b, n)
        test = F.lit(True)
        for b, n in names.items():
            test = test & ref(b).eqNullSafe(ref(n))
        out = out.join(side, test, "left")
    steps = {s.column: s for s in fit.steps if s.fills}
    columns = []
    for c in df.columns:
        s = steps.get(c)
        if s is None:
            columns.append(ref(c))
            continue
        if c in fit.values:
            fill = _literal(fit.values[c], s.out_type)
        elif fit.table is not None and f"__fill_{c}" in fit.table.columns:
            fill = ref(f"__fill_{c}")
            if isinstance(s.out_type, TIMESTAMPS) and s.action == "fill_median":
                fill = _from_micros(fill, s.out_type)
            fill = fill.cast(s.out_type)
            if s.action == "fill_most_common" and isinstance(s.out_type, T.StringType):
                fill = F.coalesce(fill, F.lit(UNKNOWN))
        else:
            columns.append(ref(c))
            continue
        kept = ref(c).cast(s.out_type)
        meta = df.schema[c].metadata
        filled = F.when(nil(df, c, fit.absent), F.coalesce(fill, kept)).otherwise(kept)
        columns.append(filled.alias(c, metadata=meta) if meta else filled.alias(c))
    return out.select(*columns)


def apply_nil_action(df: DataFrame, column: str, action: str) -> DataFrame:
    """Repair a single column."""
    return repair_nils(df, fit_nils(df, {column: action}))


def fill_median(df: DataFrame, column: str) -> DataFrame:
    return apply_nil_action(df, column, "fill_median")


def fill_zero(df: DataFrame, column: str) -> DataFrame:
    return apply_nil_action(df, column, "fill_zero")


def fill_unknown(df: DataFrame, column: str) -> DataFrame:
    return apply_nil_action(df, column, "fill_unknown")


def fill_most_common(df: DataFrame, column: str) -> DataFrame:
    return apply_nil_action(df, column, "fill_most_common")


def leave_empty(df: DataFrame, column: str) -> DataFrame:
    return apply_nil_action(df, column, "leave_empty")
