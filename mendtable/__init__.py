"""Cleaning and analysis of messy tables on Spark.

Tables are read as text, profiled, typed, deduplicated, repaired and summarized by operators that
take and return DataFrames; a ``CleaningPlan`` records the decisions and replays them elsewhere.
"""

from .functions.columns import BROADCAST_ROWS
from .operators.casts import apply_casts
from .operators.charts import chart_data
from .operators.duplicates import drop_duplicates, duplicate_count, duplicate_rows
from .operators.infer import infer_types, reconcile_types, resolve_target_type
from .operators.nils import fit_nils, nil_report, repair_nils
from .operators.profiles import merged_statistics, save_profile
from .operators.selection import (
    drop_columns,
    head_n,
    head_per_source,
    project_required,
    union_sources,
    value_counts,
)
from .operators.statistics import (
    column_statistics,
    count_distinct,
    iqr_outlier_rows,
    outlier_count,
    quartiles_iqr,
)
from .operators.summaries import (
    crosstab_counts,
    crosstab_long,
    describe_by_source,
    entity_stats,
    source_summary,
    table_profile,
)
from .plans.pipeline import apply_plan, clean_many, clean_table, freeze
from .plans.plan import CleaningPlan, ColumnDecision, fit_plan, load_plan, save_plan
from .plans.report import analysis_report, run_summary
from .session import configure
from .sources.json_text import extract_fenced_json, rows_as_json
from .sources.snapshots import read_snapshot, write_snapshot
from .sources.tables import (
    label_sources,
    read_snapshot_as_text,
    read_sources,
    read_text_table,
    rejected_rows,
    write_cleaned_snapshot,
    write_typed_snapshot,
)

__all__ = [
    "BROADCAST_ROWS", "CleaningPlan", "ColumnDecision", "analysis_report", "apply_casts", "apply_plan",
    "chart_data", "clean_many", "clean_table", "column_statistics", "configure", "count_distinct",
    "crosstab_counts", "crosstab_long", "describe_by_source", "drop_columns", "drop_duplicates",
    "duplicate_count", "duplicate_rows", "entity_stats", "extract_fenced_json", "fit_nils", "fit_plan",
    "freeze", "head_n", "head_per_source", "infer_types", "iqr_outlier_rows", "label_sources", "load_plan",
    "merged_statistics", "nil_report", "outlier_count", "project_required", "quartiles_iqr", "read_snapshot", "read_snapshot_as_text",
    "read_sources", "read_text_table", "reconcile_types", "rejected_rows", "repair_nils", "resolve_target_type",
    "rows_as_json", "run_summary", "save_plan", "save_profile", "source_summary", "table_profile", "union_sources",
    "value_counts", "write_cleaned_snapshot", "write_snapshot", "write_typed_snapshot",
]
