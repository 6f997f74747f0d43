"""Exact interpolated quantiles without holding a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here a
KLL sketch brackets each wanted rank first, then only the values inside the bracket are counted
one by one; everything else is counted in a handful of ranges. Ranks are checked against exact
counts, so the answer is exact whatever the sketch says. Each pass is one scan whose shuffle
carries sketches or bracket values only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import broadcast_if_small, group_join, local_table, ref, unpivot_as
from ..sources.workspace import materialize

SKETCH_SIZE = 8000
# The sketch's rank error is about 0.0003 (one sigma) at this size; the margin is far beyond it.
MARGIN = 0.004
GRID = 256
# A bracket with at most this many inner rows is resolved by sorting it.
BRACKET_ROWS = 2_000_000
# Groups up to this size may use the built-in exact aggregate.
SMALL_GROUP_ROWS = 200_000
# At most this many (group, column) pairs are tracked on the driver and broadcast; the values of
# further groups above SMALL_GROUP_ROWS are sorted.
TRACKED_PAIRS = 20_000
# Every pass narrows each bracket, so this many are never needed on a table that stays the same.
MOST_PASSES = 64

# The one NaN that stands for all of them where keys index a dict: it is found by identity.
_NAN = float("nan")


@dataclass
class _Target:
    """The wanted ranks of one column in one group, and a value range around each."""

    key: tuple
    column: int
    n: int
    ranks: list[int]
    fractions: list[float]
    low: list[float]
    high: list[float]
    inner: float
    found: list[float] = field(default_factory=list)

    def widen(self, i: int) -> None:
        self.low[i], self.high[i] = -math.inf, math.inf

    def merge_brackets(self) -> None:
        """Let overlapping brackets share their outer ends, so that a value lies in one only."""
        order = sorted(range(len(self.low)), key=lambda i: self.low[i])
        runs: list[list[int]] = []
        reach = -math.inf
        for i in order:
            if runs and self.low[i] <= reach:
                runs[-1].append(i)
            else:
                runs.append([i])
            reach = max(reach, self.high[i]) if len(runs[-1]) > 1 else self.high[i]
        for run in runs:
            low, high = min(self.low[i] for i in run), max(self.high[i] for i in run)
            for i in run:
                self.low[i], self.high[i] = low, high


def _target(key: tuple, column: int, n: int, edges: list[float], probs: Sequence[float]) -> _Target:
    ranks, fractions, low, high = [], [], [], []
    for i, p in enumerate(probs):
        position = p * (n - 1)
        ranks.append(math.floor(position))
        fractions.append(position - math.floor(position))
        low.append(-math.inf if p <= MARGIN else edges[2 * i])
        high.append(math.inf if p >= 1 - MARGIN else edges[2 * i + 1])
    return _Target(key, column, n, ranks, fractions, low, high, 2 * MARGIN * n)


def _lerp(a: float, b: float, t: float) -> float:
    if a == b or t == 0:
        return a
    return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


def _number(x: float) -> str:
    return f"{x!r}D" if math.isfinite(x) else f"double('{x!r}')"


def _sketch(value: str) -> str:
    return f"kll_sketch_agg_double({value}, {SKETCH_SIZE})"


def _sketch_size(value: str) -> str:
    return f"kll_sketch_get_n_double({_sketch(value)})"


def sketch_quantiles(value: str, ranks: Sequence[float], merged: bool = False) -> str:
    """Approximate quantiles of a group, or of a sketch that is ``merged`` already; null when it has no value."""
    wanted = ", ".join(_number(float(r)) for r in ranks)
    sketch = value if merged else _sketch(value)
    return f"CASE WHEN kll_sketch_get_n_double({sketch}) > 0 THEN kll_sketch_get_quantile_double({sketch}, array({wanted})) END"


def _together(parts: dict[str, str]) -> Column:
    """Many SQL expressions as one struct column; one call instead of one per expression."""
    return F.expr("named_struct(" + ", ".join(f"'{n}', {e}" for n, e in parts.items()) + ")").alias("r")


def _edges(probs: Sequence[float]) -> list[float]:
    return [min(max(p + s * MARGIN, 0.0), 1.0) for p in probs for s in (-1, 1)]


class _Job:
    """The table, its value columns and grouping that every pass of one call shares.

    Value columns are renamed ``__v0``, ``__v1``, ...; expressions over them are built as SQL
    text, which is much cheaper to assemble from Python than column objects.
    """

    def __init__(
        self,
        df: DataFrame,
        columns: dict[str, Column],
        by: Sequence[str],
        probs: Sequence[float],
        keep: Sequence[Column] = (),
    ):
        self.names = list(columns)
        self.by = list(by)
        self.key_text = ["`" + b.replace("`", "``") + "`" for b in by]
        self.keys = [ref(b) for b in by]
        self.probs = list(probs)
        values = [c.alias(f"__v{j}") for j, c in enumerate(columns.values())]
        kept = [c.alias(f"__keep{j}") for j, c in enumerate(keep)]
        clean = [f"nullif(__v{j}, double('NaN')) AS __v{j}" for j in range(len(values))]
        self.rows = df.select(*self.keys, *values, *kept).selectExpr(
            *self.key_text, *clean, *[f"__keep{j}" for j in range(len(kept))]
        )
        self.key_fields = [self.rows.schema[b] for b in by]
        self.extra: dict[str, str] = {}
        self.extra_row = None

    def key(self, row) -> tuple:
        return tuple(_NAN if isinstance(row[b], float) and row[b] != row[b] else row[b] for b in self.by)

    def first_pass(self, rows: DataFrame):
        """Sizes and sketches of every (group, column), and the targets they lead to."""
        first = dict(self.extra)
        for j in range(len(self.names)):
            first[f"n{j}"] = _sketch_size(f"__v{j}")
            first[f"edges{j}"] = sketch_quantiles(f"__v{j}", _edges(self.probs))
        fitted = rows.groupBy(*self.keys).agg(_together(first)).collect()
        if self.extra:
            self.extra_row = fitted[0]["r"]
        targets = [
            _target(self.key(row), j, row["r"][f"n{j}"], row["r"][f"edges{j}"], self.probs)
            for row in fitted
            for j in range(len(self.names))
            if row["r"][f"n{j}"]
        ]
        return fitted, targets

    def side(self, data: list[tuple], extra: Sequence[T.StructField]) -> DataFrame:
        """Broadcast side table keyed by group; its size follows from TRACKED_PAIRS alone."""
        keys = [T.StructField(f"__key{i}", f.dataType) for i, f in enumerate(self.key_fields)]
        return F.broadcast(
            local_table(self.rows.sparkSession, data, T.StructType([*keys, *extra]))
        )

    def same_group(self) -> Column:
        if not self.by:
            return F.lit(True)
        return F.expr(" AND ".join(f"{b} <=> __key{i}" for i, b in enumerate(self.key_text)))

    def with_brackets(self, targets: list[_Target]):
        """The rows, and SQL text for the bracket ends of (column, rank)."""
        if not self.by:
            ends = {t.column: t for t in targets}
            return self.rows, lambda j, i: (_number(ends[j].low[i]), _number(ends[j].high[i]))
        m = len(self.probs)
        columns = sorted({t.column for t in targets})
        groups: dict[tuple, dict[int, _Target]] = {}
        for t in targets:
            groups.setdefault(t.key, {})[t.column] = t
        data = []
        for key, by_column in groups.items():
            ends = []
            for j in columns:
                t = by_column.get(j)
                ends += [*t.low, *t.high] if t else [None] * (2 * m)
            data.append((*key, *ends))
        fields = [
            T.StructField(f"__{end}{j}_{i}", T.DoubleType())
            for j in columns
            for end in ("low", "high")
            for i in range(m)
        ]
        rows = self.rows.join(self.side(data, fields), self.same_group())
        return rows, lambda j, i: (f"__low{j}_{i}", f"__high{j}_{i}")

    def resolve(self, targets: list[_Target]) -> None:
        """Rank the bracket values, in one pass: values between brackets are counted by the gap they
        fall in, values inside one by one, and the ranks run through both in order."""
        for t in targets:
            t.merge_brackets()
            t.inner = math.inf
        m = len(self.probs)
        ascending = sorted(range(m), key=lambda i: self.probs[i])
        columns = sorted({t.column for t in targets})
        rows, ends = self.with_brackets(targets)
        spots = {}
        for j in columns:
            v = f"__v{j}"
            cases, inside = [], []
            for place, i in enumerate(ascending):
                low, high = ends(j, i)
                cases.append(f"WHEN {v} < {low} THEN {2 * place} WHEN {v} <= {high} THEN {2 * place + 1}")
                inside.append(f"{v} BETWEEN {low} AND {high}")
            spots[v] = F.expr(
                f"CASE WHEN {v} IS NOT NULL THEN named_struct('spot', CASE {' '.join(cases)} ELSE {2 * m} END,"
                f" 'at', CASE WHEN {' OR '.join(inside)} THEN {v} END) END"
            )
        counts = (
            unpivot_as(rows, spots, self.by, "value")
            .filter("value IS NOT NULL")
            .selectExpr(*self.key_text, "column_name", "value.spot", "value.at")
            .groupBy(*self.keys, "column_name", "spot", "at")
            .agg(F.expr("count(1) AS cnt"))
        )
        side = self.side(
            [(*t.key, f"__v{t.column}", *t.ranks) for t in targets],
            [T.StructField("__column", T.StringType()), *[T.StructField(f"__k{i}", T.LongType()) for i in range(m)]],
        )
        run = counts.join(side, self.same_group() & F.expr("column_name = __column"))
        w = Window.partitionBy(*self.keys, "column_name").orderBy("spot", "at")
        run = run.withColumn("end", F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        picks = {}
        for i in range(m):
            for name, k in ((f"a{i}", f"__k{i}"), (f"b{i}", f"__k{i} + 1")):
                picks[name] = f"max(CASE WHEN end - cnt <= {k} AND {k} < end THEN at END)"
        picked = run.groupBy(*self.keys, "column_name").agg(_together(picks)).collect()
        hits = {(self.key(r), int(r["column_name"][3:])): r["r"] for r in picked}
        for t in targets:
            found, r = [], hits.get((t.key, t.column))
            for i, fraction in enumerate(t.fractions):
                a, b = (r[f"a{i}"], r[f"b{i}"]) if r is not None else (None, None)
                if a is None or (b is None and fraction > 0):
                    t.widen(i)
                else:
                    found.append(_lerp(a, b, fraction))
            if len(found) == len(t.ranks):
                t.found = found

    def narrow(self, targets: list[_Target]) -> None:
        """Exact counts around each bracket and a fresh sketch of what lies strictly inside."""
        rows, ends = self.with_brackets(targets)
        grid = [i / GRID for i in range(GRID + 1)]
        aggs = {}
        for j in sorted({t.column for t in targets}):
            v = f"__v{j}"
            for i in range(len(self.probs)):
                low, high = ends(j, i)
                inner = f"CASE WHEN {v} > {low} AND {v} < {high} THEN {v} END"
                aggs |= {
                    f"below{j}_{i}": f"count_if({v} < {low})",
                    f"at_low{j}_{i}": f"count_if({v} <= {low})",
                    f"through{j}_{i}": f"count_if({v} <= {high})",
                    f"inner{j}_{i}": f"count({inner})",
                    f"grid{j}_{i}": sketch_quantiles(inner, grid),
                }
        index: dict[tuple, list[_Target]] = {}
        for t in targets:
            index.setdefault(t.key, []).append(t)
        for row in rows.groupBy(*self.keys).agg(_together(aggs)).collect():
            for t in index[self.key(row)]:
                t.inner = sum(
                    self._tighten(t, i, *[row["r"][f"{x}{t.column}_{i}"] for x in _COUNTS])
                    for i in range(len(t.ranks))
                )

    @staticmethod
    def _tighten(t: _Target, i: int, below: int, at_low: int, through: int, inner: int, grid) -> float:
        """Move the ends of bracket ``i`` inwards; returns how many rows remain inside."""
        k = t.ranks[i]
        last_rank = k + (1 if t.fractions[i] > 0 else 0)
        if not below <= k or not last_rank < through:
            t.widen(i)
            return math.inf
        if inner <= BRACKET_ROWS // len(t.ranks):
            return inner
        first = math.floor(((k - at_low) / inner - MARGIN) * GRID)
        last = math.ceil(((k + 1 - at_low) / inner + MARGIN) * GRID)
        first, last = max(first, 0), min(last, GRID)
        if first > 0:
            t.low[i] = grid[min(first, GRID)]
        if last < GRID:
            t.high[i] = grid[max(last, 0)]
        return inner * (last - first) / GRID

    def solve(self, targets: list[_Target]) -> None:
        pending = targets
        for _ in range(MOST_PASSES):
            if not pending:
                return
            wide = [t for t in pending if t.inner > BRACKET_ROWS]
            tight = [t for t in pending if t.inner <= BRACKET_ROWS]
            if wide:
                self.narrow(wide)
            if tight:
                self.resolve(tight)
            pending = [t for t in pending if not t.found]
        if pending:
            raise RuntimeError("quantiles do not settle: the table gives other rows on every pass; write it first")


_COUNTS = ("below", "at_low", "through", "inner", "grid")


def table_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probs: Sequence[float],
    moments: dict[str, str] | None = None,
    extra: dict[str, tuple[Column, str]] | None = None,
) -> tuple[dict[str, list[float] | None], dict]:
    """Exact linear-interpolation quantiles of whole columns, and other aggregates on the way.

    ``columns`` maps a name to a double expression over ``df``; null and NaN are ignored and a
    column without values maps to None. ``moments`` names SQL aggregates over ``{}`` for each of
    these columns, returned under (name, column); ``extra`` maps a name to a column of ``df`` and
    a SQL aggregate over it. Both ride on the first scan. Like ``DataFrame.approxQuantile`` this
    runs jobs at call time and collects a few numbers a column.
    """
    extra = extra or {}
    job = _Job(df, columns, (), probs, [c for c, _ in extra.values()])
    wanted = {(m, c): text.format(f"__v{j}") for j, c in enumerate(columns) for m, text in (moments or {}).items()}
    wanted |= {n: text.format(f"__keep{j}") for j, (n, (_, text)) in enumerate(extra.items())}
    job.extra = {f"extra{i}": text for i, text in enumerate(wanted.values())}
    targets: list[_Target] = []
    if columns:
        _, targets = job.first_pass(job.rows)
        job.solve(targets)
    elif job.extra:
        job.extra_row = job.rows.agg(_together(job.extra)).first()["r"]
    found = {job.names[t.column]: t.found for t in targets}
    extras = {n: job.extra_row[f"extra{i}"] for i, n in enumerate(wanted)}
    return {c: found.get(c) for c in columns}, extras


def grouped_quantiles(
    df: DataFrame, columns: dict[str, Column], probs: Sequence[float], by: Sequence[str]
) -> DataFrame:
    """Exact quantiles per group: columns ``by``, ``column_name``, ``q`` (array, null if no value).

    Groups above SMALL_GROUP_ROWS rows are solved as in ``table_quantiles``, all in the same
    passes, so one hot group costs no task more than its share. As many of the largest are taken
    as make TRACKED_PAIRS (group, column) pairs. Where there are more large groups, the values of
    the others are sorted across tasks. Groups up to SMALL_GROUP_ROWS use the built-in aggregate.
    """
    job = _Job(df, columns, by, probs)
    sizes = job.rows.groupBy(*job.keys).agg(F.expr("count(1) AS __n"))
    most = max(1, TRACKED_PAIRS // len(columns))
    many = sizes.filter(F.col("__n") > SMALL_GROUP_ROWS)
    large = many.orderBy(F.desc("__n"), *job.keys).limit(most).collect()
    small, solved, rest = job.rows, None, []
    if large:
        side = job.side([job.key(r) for r in large], [])
        small = job.rows.join(side, job.same_group(), "left_anti")
        job.rows = job.rows.join(side, job.same_group(), "left_semi")
        if len(large) == most:
            others = broadcast_if_small(many.join(side, job.same_group(), "left_anti").drop("__n"))
            rest.append(_sorted_quantiles(group_join(small, others, by, "left_semi"), job, probs))
            small = group_join(small, others, by, "left_anti")
        fitted, targets = job.first_pass(job.rows)
        job.solve(targets)
        found = {(t.key, t.column): t.found for t in targets}
        data = [
            (*job.key(r), c, found.get((job.key(r), j)))
            for r in fitted
            for j, c in enumerate(job.names)
        ]
        schema = T.StructType(
            [
                *job.key_fields,
                T.StructField("column_name", T.StringType()),
                T.StructField("q", T.ArrayType(T.DoubleType())),
            ]
        )
        solved = local_table(df.sparkSession, data, schema)
    wanted = ", ".join(_number(float(p)) for p in probs)
    picked = small.groupBy(*job.keys).agg(
        _together({f"v{j}": f"percentile(__v{j}, array({wanted}))" for j in range(len(job.names))})
    )
    rest.append(unpivot_as(picked, {c: F.col(f"r.v{j}") for j, c in enumerate(job.names)}, by, "q"))
    if solved is not None:
        rest.append(solved)
    return reduce(DataFrame.unionByName, rest)


def sorted_shares(ranged: DataFrame) -> DataFrame:
    """A table that is partitioned by range, written once; ``__task`` tells each row's share."""
    return materialize(ranged.withColumn("__task", F.spark_partition_id()), "sorted-values")[0]


def quantiles_of_counts(counted: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of values ``at`` that occur ``cnt`` times: ``group``, ``q``. Values are sorted across tasks."""
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return quantiles_of_shares(sorted_shares(counted.repartitionByRange(tasks, *[ref(g) for g in group], "at")), group, probs)


def quantiles_of_shares(shares: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of counted values from shares that follow each other in order of group and value: a group's ranks run
    on from one share to the next, and only shares that hold a wanted rank are sorted."""
    keys = [ref(g) for g in group]
    picks, here = {}, []
    for i, p in enumerate(probs):
        k = f"floor({_number(float(p))} * (__n - 1))"
        for name, rank in (("a", k), ("b", f"least({k} + 1, __n - 1)")):
            picks[f"{name}{i}"] = f"max(CASE WHEN __end - cnt <= {rank} AND {rank} < __end THEN at END)"
            here.append(f"__before <= {rank} AND {rank} < __before + __share")
    sums = shares.groupBy(*keys, "__task").agg(F.sum("cnt").alias("__share"))
    of_group = Window.partitionBy(*keys)
    before = of_group.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumns(
        {"__before": F.coalesce(F.sum("__share").over(before), F.lit(0)), "__n": F.sum("__share").over(of_group)}
    ).filter(" OR ".join(here)).drop("__share")
    w = Window.partitionBy(*keys, "__task").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    run = group_join(shares, broadcast_if_small(placed), group, on=["__task"]).withColumn(
        "__end", F.col("__before") + F.sum("cnt").over(w)
    )
    found = run.groupBy(*keys).agg(F.max("__n").alias("__n"), _together(picks))
    quantiles = []
    for i, p in enumerate(probs):
        position = f"({_number(float(p))} * (__n - 1))"
        t, a, b = f"({position} - floor({position}))", f"r.a{i}", f"r.b{i}"
        quantiles.append(
            f"CASE WHEN {a} = {b} OR {t} = 0 THEN {a}"
            f" WHEN {t} >= 0.5D THEN {b} - ({b} - {a}) * (1 - {t}) ELSE {a} + ({b} - {a}) * {t} END"
        )
    return found.select(*keys, F.expr(f"array({', '.join(quantiles)})").alias("q"))


def _sorted_quantiles(rows: DataFrame, job: _Job, probs: Sequence[float]) -> DataFrame:
    """Quantiles of any number of groups of any size."""
    values = {c: F.col(f"__v{j}") for j, c in enumerate(job.names)}
    group = [*job.by, "column_name"]
    keys = [ref(g) for g in group]
    counted = (
        unpivot_as(rows, values, job.by, "at").filter("at IS NOT NULL").groupBy(*keys, "at").agg(F.expr("count(1) AS cnt"))
    )
    listed = quantiles_of_counts(counted, group, probs)
    # a group without values in a column has a row without quantiles
    every = unpivot_as(
        rows.groupBy(*job.keys).agg(F.count(F.lit(1)).alias("__rows")), {c: F.lit(None).cast("int") for c in job.names}, job.by
    )
    return group_join(every, listed, job.by, "left", ["column_name"]).select(*keys, "q")
