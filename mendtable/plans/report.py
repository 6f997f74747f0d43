"""Analysis of stacked, cleaned tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import group_join
from ..operators.selection import SOURCE, head_per_source, project_required
from ..operators.summaries import (
    category_levels,
    crosstab_counts,
    crosstab_long,
    describe_by_source,
    entity_stats,
    source_records,
    total_records,
)
from ..sources.logs import SHOWN_ENTRIES, log_head

# The default task's width.
DEFAULT_COLUMNS = 5


@dataclass(frozen=True)
class AnalysisTask:
    name: str
    description: str
    required_columns: tuple[str, ...]
    analysis_type: str = "comparison"
    group_by: str | None = None


def default_task(columns: Sequence[str], source: str = SOURCE) -> AnalysisTask:
    names = [c for c in columns if c != source]
    return AnalysisTask(
        "Sources side by side", "The main columns of every source next to each other", tuple(names[:DEFAULT_COLUMNS])
    )


class ReportParts(Mapping[str, DataFrame]):
    """Parts of a report, each built when it is asked for and kept."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def analysis_report(
    df: DataFrame,
    required_columns: Sequence[str],
    group_by: str | None = None,
    order_by: Sequence[str] | None = None,
    source: str = SOURCE,
    levels: Sequence | None = None,
) -> ReportParts:
    """The parts of a report: ``sample`` (with ``order_by``), ``describe``, ``entity_stats``,
    ``total_records``, and with ``group_by`` ``breakdown`` and ``breakdown_long``.

    Nothing runs until a part is asked for; ``describe`` (medians) and the breakdowns (the levels,
    once for both, unless given) then run jobs of their own.
    """
    slim = project_required(df, required_columns, group_by, source)
    parts: dict[str, Callable[[], DataFrame]] = {
        "describe": lambda: describe_by_source(slim, source),
        "entity_stats": lambda: group_join(entity_stats(slim, source), source_records(df, source), [source]),
        "total_records": lambda: total_records(df),
    }
    if order_by:
        carried = project_required(df, [*required_columns, *order_by], group_by, source)
        parts["sample"] = lambda: head_per_source(carried, order_by, source=source).select(
            *slim.columns, "place", "source_rows"
        )
    if group_by and group_by in df.columns:
        known: list = []

        def shown() -> list:
            if not known:
                known.append(list(levels) if levels is not None else category_levels(df, group_by))
            return known[0]

        parts["breakdown"] = lambda: crosstab_counts(df, group_by, source, levels=shown())
        parts["breakdown_long"] = lambda: crosstab_long(df, group_by, source, levels=shown())
    return ReportParts(parts)


def run_summary(df: DataFrame, log: DataFrame, source: str = SOURCE) -> dict[str, DataFrame]:
    """Records per source, the number of log entries, and the first of them."""
    return {
        "records": source_records(df, source),
        "log_entries": log.agg(F.count(F.lit(1)).alias("log_entries")),
        "log_head": log_head(log, SHOWN_ENTRIES),
    }
