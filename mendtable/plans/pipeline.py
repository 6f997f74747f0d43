"""Cleaning one table or many by a plan: cast, drop duplicates, repair nils, drop columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import broadcast_if_small, local_table, quoted, ref, text_columns, unused_name
from ..functions.parsing import all_integers_sql
from ..operators.casts import CastStep, integral_columns, parsed_column, plan_casts, run_casts
from ..operators.duplicates import drop_duplicates
from ..operators.nils import NilFit, fit_nils, repair_nils, stored_fit
from ..operators.selection import SOURCE, common_type, drop_columns, stack_by_name, union_sources, with_source_column
from ..operators.statistics import column_statistics
from ..sources.logs import ProcessingLog
from ..sources.tables import write_cleaned_snapshot, write_typed_snapshot
from ..sources.workspace import discard, materialize
from .plan import CleaningPlan, decide_by_source, decide_columns, fit_plan


@dataclass
class Cleaned:
    """Result of cleaning: the typed and the cleaned table, the log, and the fits behind them.

    ``table`` reads intermediate tables in the shared folder; ``close`` deletes them once the result
    has been written elsewhere. With snapshots that happens by itself.
    """

    typed: DataFrame
    table: DataFrame
    before_repair: DataFrame
    before_drop: DataFrame
    log: ProcessingLog
    casts: list[CastStep]
    nils: NilFit
    scratch: list[str] = field(default_factory=list)

    def statistics(self) -> DataFrame:
        """Column statistics as they are before columns are dropped."""
        return column_statistics(self.before_drop)

    def close(self) -> None:
        while self.scratch:
            discard(self.table.sparkSession, self.scratch.pop())


@dataclass(frozen=True)
class Layouts:
    """Which columns each source of a stacked table has. Sources share few layouts, whose number each row holds in
    ``column``."""

    column: str
    of: Mapping[object, int]
    columns: Sequence[tuple[str, ...]]

    def has(self, source: object, c: str) -> bool:
        return source not in self.of or c in self.columns[self.of[source]]

    def absent(self, names: Sequence[str]) -> dict[str, Column]:
        """For columns that some layouts lack, the rows of those."""
        lacking = {c: [i for i, has in enumerate(self.columns) if c not in has] for c in names}
        return {c: ref(self.column).isin(ids) for c, ids in lacking.items() if ids}


@dataclass
class _Casts:
    """The casts of a table, or of every source of a stacked one."""

    typed: DataFrame
    steps: list[CastStep]
    by_source: dict[object, list[CastStep]]


def _whole_by_source(df: DataFrame, columns: Sequence[str], by: str) -> tuple[dict[object, set[str]], dict[object, int]]:
    """For every source the columns whose numbers are all integers, and its number of rows; one row per source."""
    flags = [F.expr(all_integers_sql(quoted(c))).alias(f"f{j}") for j, c in enumerate(columns)]
    rows = df.groupBy(ref(by).alias("__source")).agg(F.count(F.lit(1)).alias("n"), *flags).collect()
    return {r["__source"]: {c for j, c in enumerate(columns) if r[f"f{j}"]} for r in rows}, {r["__source"]: r["n"] for r in rows}


@dataclass
class Decided:
    """The casts of every source of a stacked table, and how many rows each has."""

    casts: dict[object, list[CastStep]]
    rows: dict[object, int]


def _decide_sources(
    df: DataFrame, plan: CleaningPlan, order_by: Sequence[str] | None, by: str, layouts: Layouts | None = None
) -> Decided:
    """The casts of every source of a stacked table, as if it stood alone; of its own columns only."""
    carried = [c for c in order_by or () if c not in plan.columns]
    unknown = [c for c in text_columns(df) if c not in plan.columns and c not in carried and c != by]
    inferred = decide_by_source(df, unknown, by, order_by) if unknown else {}
    targets = plan.targets(df)
    ints = [c for c, t in targets.items() if t == "integer"]
    whole, sizes = _whole_by_source(df, ints, by)
    own: dict[object, dict[str, str]] = {}
    for s in whole:
        has = df.columns if layouts is None or s not in layouts.of else layouts.columns[layouts.of[s]]
        own[s] = {c: targets[c] for c in has if c in targets}
        for c, found in inferred.items():
            if c not in has:
                continue
            target, integral = found.get(s, (None, False))
            if target:
                own[s][c] = target
                if target == "integer" and integral:
                    whole[s].add(c)
    return Decided({s: plan_casts(df, own[s], whole[s]) for s in own}, sizes)


def _casts_without_rows(df: DataFrame, plan: CleaningPlan) -> list[CastStep]:
    """The casts of a table that has no row to speak against them."""
    targets = plan.targets(df)
    return plan_casts(df, targets, {c for c, t in targets.items() if t == "integer"})


def _cast_sources(
    df: DataFrame, steps: dict[object, list[CastStep]], by: str, layouts: Layouts | None = None
) -> _Casts:
    """Cast a stacked table, every source in its own way.

    A column that comes out alike everywhere is cast plainly. Where sources differ, because only
    some hold integers or because the plan does not know the column, the results are brought to the
    type that stacking gives.
    """
    outcome: dict[str, dict[object, str | None]] = {}
    for s, of_source in steps.items():
        for step in of_source:
            outcome.setdefault(step.column, {})[s] = step.target
    for c, of_column in outcome.items():
        for s in steps:
            if layouts is None or layouts.has(s, c):
                of_column.setdefault(s, None)
    mixed = {c for c, found in outcome.items() if c in df.columns and len(set(found.values())) > 1}
    every = {step.column: step for of_source in steps.values() for step in of_source}
    if not mixed:
        shared = list(every.values())
        return _Casts(run_casts(df, shared), shared, steps)
    columns = sorted(mixed)
    key = unused_name(df, "__source")
    kind = df.schema[by].dataType
    fields = [T.StructField(key, kind), *(T.StructField(f"__to{j}", T.StringType()) for j in range(len(columns)))]
    rows = [(s, *(outcome[c].get(s) for c in columns)) for s in steps]
    side = broadcast_if_small(local_table(df.sparkSession, rows, T.StructType(fields)))
    joined = df.join(side, ref(by).eqNullSafe(ref(key)), "left")
    out = []
    for c in df.columns:
        if c not in mixed:
            out.append(ref(c))
            continue
        to = F.col(f"__to{columns.index(c)}")
        used = sorted({t for t in outcome[c].values() if t})
        parsed = {t: parsed_column(df, c, t) for t in used}
        kinds = [df.select(p.alias("x")).schema["x"].dataType for p in parsed.values()]
        if None in outcome[c].values():
            kinds.append(df.schema[c].dataType)
        target = common_type(kinds)
        value = ref(c).cast(target)
        for t, p in parsed.items():
            value = F.when(to == t, p.cast(target)).otherwise(value)
        out.append(value.alias(c))
    shared = [s for s in every.values() if s.column not in mixed]
    return _Casts(run_casts(joined.select(*out), shared), shared, steps)


def clean_table(
    df: DataFrame,
    plan: CleaningPlan,
    order_by: Sequence[str] | None = None,
    frozen: bool = False,
    by: str | None = None,
    snapshots: str | None = None,
    label: str = "table",
    file_number: int = 1,
    files: Mapping[object, int] | None = None,
    decided: Decided | None = None,
    layouts: Layouts | None = None,
) -> Cleaned:
    """Replay a plan on a text table.

    Columns the plan does not know are inferred and cast if confident. With ``by`` the table is a
    stack of sources, and every decision and fit is made per source, all sources in the same jobs;
    ``files`` gives each source's number in the log, ``decided`` its casts where they are known,
    ``layouts`` the columns each source has where they have not all the same.
    ``frozen`` uses the plan's fitted values and
    runs no job: integers that are none become null, and columns change their types as they did in
    the first table. ``snapshots`` is a folder for the typed and the cleaned table. Rows that
    ``order_by`` carries for ordering only are dropped after inference.
    """
    plan.check()
    log, scratch = ProcessingLog(), []
    carried = [c for c in order_by or () if c not in plan.columns]
    targets = plan.targets(df)
    unknown = [c for c in text_columns(df) if c not in plan.columns and c not in carried and c != by]
    data = drop_columns(df, carried)
    if by and not frozen:
        decided = decided or _decide_sources(df, plan, order_by, by, layouts)
        done = _cast_sources(data, decided.casts or {None: _casts_without_rows(data, plan)}, by, layouts)
    else:
        integral = set(plan.integral or ())
        if not frozen:
            whole: set[str] = set()
            planned = [c for c, t in targets.items() if t == "integer"]
            if unknown:
                decisions, whole = decide_columns(df, unknown, order_by)
                targets |= {c: d.target for c, d in decisions.items() if d.target}
            integral = integral_columns(data, planned) | whole
        steps = plan_casts(data, targets, integral)
        done = _Casts(run_casts(data, steps), steps, {})
    typed, casts = done.typed, done.steps
    if snapshots:
        path = write_typed_snapshot(typed, snapshots, label)
        typed = typed.sparkSession.read.schema(typed.schema).parquet(path)

    rows, copies = typed, {}
    if frozen:
        if plan.drop_duplicates:
            rows = drop_duplicates(rows)
    elif plan.drop_duplicates:
        seen, kept = Observation(), Observation()
        n = F.count(F.lit(1)).alias("n")
        rows, path = materialize(drop_duplicates(typed.observe(seen, n)).observe(kept, n), f"{label}-deduplicated")
        scratch.append(path)
        if not files:
            copies = {None: _observed(seen, typed) - _observed(kept, rows)}
    elif not snapshots:
        rows, path = materialize(rows, f"{label}-typed")
        scratch.append(path)

    if frozen:
        nils = stored_fit(rows, plan.nil_actions, plan.fills or {})
    else:
        absent = layouts.absent(rows.columns) if layouts else None
        nils = fit_nils(rows, plan.nil_actions, [by] if by else (), group_steps=files is not None, absent=absent)
    if files and plan.drop_duplicates and not frozen and by:
        left = nils.group_rows or _counts(rows, by)
        copies = {s: n - left.get(s, 0) for s, n in decided.rows.items()}
    repaired = repair_nils(rows, nils)
    gone = [c for c in plan.columns_to_drop if c in repaired.columns]
    table = drop_columns(repaired, [*gone, *([layouts.column] if layouts else [])])
    if snapshots:
        path = write_cleaned_snapshot(table, snapshots, label, [by] if by else ())

    for s, number in (files or {None: file_number}).items():
        for step in done.by_source.get(s, casts):
            log.add(number, step.message)
        if not plan.drop_duplicates:
            log.add(number, "Kept duplicate rows")
        elif frozen:
            log.add(number, "Dropped duplicate rows")
        else:
            n = copies.get(s, 0) if files or not by else sum(copies.values())
            log.add(number, f"Dropped {n} duplicate rows" if n else "No duplicate rows found")
        for step in nils.group_steps.get(s, nils.steps):
            if layouts is None or layouts.has(s, step.column):
                log.add(number, step.message)
        lost = [c for c in gone if layouts is None or layouts.has(s, c)]
        log.add(number, f"Dropped columns: {lost}" if lost else "No columns dropped")
        if snapshots:
            log.add(number, f"Saved to {path}")
    cleaned = Cleaned(typed, table, rows, repaired, log, casts, nils, scratch)
    if snapshots:
        cleaned.table = table.sparkSession.read.schema(table.schema).parquet(path).select(*[ref(c) for c in table.columns])
    return cleaned


def _observed(observation: Observation, df: DataFrame) -> int:
    """The observed number of rows; counted where the optimizer found a table empty and dropped the
    observation with it."""
    try:
        return observation.get["n"]
    except (KeyError, Py4JError):
        return df.count()


def _counts(df: DataFrame, by: str) -> dict[object, int]:
    """Rows of every source."""
    return {r["__source"]: r["n"] for r in df.groupBy(ref(by).alias("__source")).agg(F.count(F.lit(1)).alias("n")).collect()}


def freeze(plan: CleaningPlan, cleaned: Cleaned) -> CleaningPlan:
    """The plan with the fill values and integer columns a cleaning run has fitted. Medians and most
    common values of columns that had no nils are fitted now, for tables that will."""
    nils = cleaned.nils
    fitted = ("fill_median", "fill_most_common")
    if any(a in fitted and c in cleaned.before_repair.columns and c not in nils.values for c, a in plan.nil_actions.items()):
        nils = fit_nils(cleaned.before_repair, plan.nil_actions, always=True)
    fills = {c: str(v) for c, v in nils.values.items()}
    whole = sorted(s.column for s in cleaned.casts if s.target == "integer")
    return replace(plan, fills=fills, integral=whole)


def apply_plan(df: DataFrame, plan: CleaningPlan, **options) -> DataFrame:
    """The cleaned table a plan makes of a text table."""
    return clean_table(df, plan, **options).table


def clean_many(
    tables: Mapping[str, DataFrame],
    plan: CleaningPlan | None = None,
    order_by: Sequence[str] | None = None,
    source: str = SOURCE,
    **fit_options,
) -> tuple[DataFrame, CleaningPlan, ProcessingLog]:
    """Clean several text tables by one plan, fitted on the first table unless given.

    Every table is cleaned as if it stood alone, and the results are stacked by name. All tables are
    stacked first, whatever columns each has, and decided in the same jobs, grouped by source; those
    that do not contradict each other in a column's type are cleaned in the same jobs. So the number
    of jobs grows neither with the number of files nor with that of their layouts.
    """
    if plan is None:
        plan = fit_plan(next(iter(tables.values())), order_by, **fit_options)
    numbers = {label: i for i, label in enumerate(tables, 1)}
    results, entries = [], []
    for group in _agreeing({label: {f.name: f.dataType.simpleString() for f in t.schema} for label, t in tables.items()}):
        if len(group) == 1:
            (label,) = group
            done = clean_table(tables[label], plan, order_by, label=label, file_number=numbers[label])
            results.append(with_source_column(done.table, label, source))
            entries += done.log.entries
            continue
        stacked, layouts = _stacked({label: tables[label] for label in group}, source)
        casts = _decide_sources(stacked, plan, order_by, source, layouts)
        steps = {label: casts.casts[label] if label in casts.casts else _casts_without_rows(tables[label], plan) for label in group}
        targets = {label: {s.column: s.target or "" for s in of_table} for label, of_table in steps.items()}
        # a column that a table has and that is not cast stays text
        targets = {label: {c: "" for c in tables[label].columns} | found for label, found in targets.items()}
        for alike in _agreeing(targets):
            if len(alike) < len(group):
                stacked, layouts = _stacked({label: tables[label] for label in alike}, source)
            files = {label: numbers[label] for label in alike}
            decided = Decided({label: steps[label] for label in alike}, casts.rows)
            done = clean_table(stacked, plan, order_by, by=source, label="sources", files=files, decided=decided, layouts=layouts)
            results.append(done.table)
            entries += done.log.entries
    return stack_by_name(results), plan, ProcessingLog(sorted(entries, key=lambda e: e[0]))


def _agreeing(kinds: Mapping[str, Mapping[str, str]]) -> list[list[str]]:
    """Tables in groups, each in the first in which no column is of another kind."""
    groups: list[tuple[dict[str, str], list[str]]] = []
    for label, own in kinds.items():
        for known, labels in groups:
            if all(known.get(c, kind) == kind for c, kind in own.items()):
                break
        else:
            known, labels = {}, []
            groups.append((known, labels))
        known.update(own)
        labels.append(label)
    return [labels for _, labels in groups]


def _stacked(tables: Mapping[str, DataFrame], source: str) -> tuple[DataFrame, Layouts | None]:
    """Tables stacked by name; where they have not all the same columns, with the number of each row's layout."""
    kinds: dict[tuple[str, ...], int] = {}
    of = {label: kinds.setdefault(tuple(t.columns), len(kinds)) for label, t in tables.items()}
    if len(kinds) == 1:
        return union_sources(tables, source), None
    taken = {c for t in tables.values() for c in t.columns}
    column = next(name for i in range(len(taken) + 1) if (name := f"__layout{i}") not in taken)
    numbered = {label: t.withColumn(column, F.lit(of[label])) for label, t in tables.items()}
    return union_sources(numbered, source), Layouts(column, of, list(kinds))
