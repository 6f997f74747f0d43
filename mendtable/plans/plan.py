"""The declarative cleaning plan: decided once, saved as JSON, replayed on many tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref, unpivot_as
from ..operators.infer import APPROVAL_CONFIDENCE, infer_types, reconcile_types
from ..operators.nils import ALL_ACTIONS, NUMERIC_ACTIONS, OTHER_ACTIONS
from ..sources.tables import path_exists
from ..sources.workspace import materialize

COLUMN_DECISION = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("approved", T.BooleanType()),
        T.StructField("correction", T.StringType()),
    ]
)
# The field names of a saved plan.
PLAN_SCHEMA = T.StructType(
    [
        T.StructField("stored_column_decisions", T.MapType(T.StringType(), COLUMN_DECISION)),
        T.StructField("stored_duplicate_decision", T.BooleanType()),
        T.StructField("stored_nil_decisions", T.MapType(T.StringType(), T.StringType())),
        T.StructField("stored_columns_to_drop", T.ArrayType(T.StringType())),
        T.StructField("fitted_integral_columns", T.ArrayType(T.StringType())),
        T.StructField("fitted_fill_values", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fitted_category_levels", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("has_level_table", T.BooleanType()),
    ]
)
SKIP = "skip"
NUMERIC_TARGETS = ("integer", "float", "currency")
# A plan lists the levels of a categorical column that has at most this many; those of others are a table
# beside it.
LISTED_LEVELS = 1000


@dataclass(frozen=True)
class ColumnDecision:
    """The type decided for a column, whether it was approved, and a correction (or ``skip``)."""

    type: str
    approved: bool = True
    correction: str | None = None

    @property
    def target(self) -> str | None:
        if self.correction == SKIP:
            return None
        if self.correction is not None:
            return self.correction
        return self.type if self.approved else None


@dataclass
class CleaningPlan:
    """All decisions about a table. A stored choice is used for its own column only.

    ``integral`` and ``fills`` are fitted on the table the plan was made from and used by a frozen
    replay alone; a normal replay fits every table anew. ``levels`` holds the values of categorical
    columns, in order, so that cross tabulations of later tables have the same columns.
    """

    columns: dict[str, ColumnDecision] = field(default_factory=dict)
    drop_duplicates: bool | None = None
    nil_actions: dict[str, str] = field(default_factory=dict)
    columns_to_drop: list[str] = field(default_factory=list)
    integral: list[str] | None = None
    fills: dict[str, str] | None = None
    levels: dict[str, list[str]] = field(default_factory=dict)
    preloaded: bool = False
    level_table: DataFrame | None = field(default=None, compare=False)

    def levels_of(self, column: str) -> list[str] | DataFrame | None:
        """The stored levels of a column: listed, or a table of one column, or None if there are none."""
        if column in self.levels or column not in self.columns or self.level_table is None:
            return self.levels.get(column)
        return self.level_table.filter(F.col("column_name") == column).select("value")

    def check(self, new: bool = False) -> None:
        """Raise when a nil action does not suit the type the plan gives its column.

        A new plan may only use the actions offered for a column of that kind. A plan that exists is
        refused only where an action cannot be carried out: there is no median of text.
        """
        for c, action in self.nil_actions.items():
            target = self.columns[c].target if c in self.columns else None
            if target is None:
                allowed = ALL_ACTIONS
            elif target in NUMERIC_TARGETS:
                allowed = NUMERIC_ACTIONS if new else ALL_ACTIONS
            else:
                dates = ["fill_zero", *["fill_median"] * (target == "datetime")]
                allowed = OTHER_ACTIONS + dates * (not new)
            if action not in allowed:
                raise ValueError(f"{action!r} does not apply to column {c!r} of type {target!r}")

    def targets(self, df: DataFrame) -> dict[str, str]:
        """Target type of every planned column that ``df`` has, in schema order."""
        wanted = {c: self.columns[c].target for c in df.columns if c in self.columns}
        return {c: t for c, t in wanted.items() if t is not None}

    def to_df(self, spark: SparkSession) -> DataFrame:
        decisions = {c: (d.type, d.approved, d.correction) for c, d in self.columns.items()}
        row = (
            decisions, self.drop_duplicates, self.nil_actions, self.columns_to_drop,
            self.integral, self.fills, self.levels, self.level_table is not None,
        )
        return spark.createDataFrame([row], PLAN_SCHEMA)

    @staticmethod
    def from_row(row, preloaded: bool = False) -> CleaningPlan:
        decisions = {
            c: ColumnDecision(d["type"], bool(d["approved"]), d["correction"])
            for c, d in (row["stored_column_decisions"] or {}).items()
        }
        return CleaningPlan(
            decisions,
            row["stored_duplicate_decision"],
            dict(row["stored_nil_decisions"] or {}),
            list(row["stored_columns_to_drop"] or []),
            row["fitted_integral_columns"],
            row["fitted_fill_values"],
            {c: list(v) for c, v in (row["fitted_category_levels"] or {}).items()},
            preloaded,
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the plan as one JSON document, and long lists of levels as a table next to it."""
        if self.level_table is not None:
            self.level_table.write.mode("overwrite").parquet(_level_path(path))
        self.to_df(spark).coalesce(1).write.mode("overwrite").option(
            "ignoreNullFields", "false"
        ).json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> CleaningPlan | None:
        """Read a saved plan, from a single pretty-printed file too; None where there is none."""
        if not path_exists(spark, path):
            return None
        row = spark.read.schema(PLAN_SCHEMA).option("multiLine", True).json(path).first()
        if row is None:
            return None
        plan = CleaningPlan.from_row(row, preloaded=True)
        if row["has_level_table"]:
            plan.level_table = spark.read.schema(LEVELS).parquet(_level_path(path))
        return plan


def _level_path(path: str) -> str:
    return path.rstrip("/") + "_levels"


def save_plan(plan: CleaningPlan, spark: SparkSession, path: str) -> None:
    plan.save(spark, path)


def load_plan(spark: SparkSession, path: str) -> CleaningPlan | None:
    return CleaningPlan.load(spark, path)


def decide_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    suggestions: DataFrame | None = None,
    corrections: dict[str, str] | None = None,
    approve_all: bool = False,
) -> tuple[dict[str, ColumnDecision], set[str]]:
    """Type decisions for text columns, and the columns whose numbers are all integers.

    ``suggestions`` is an outside opinion per column, ``corrections`` a caller's answer per column
    (a type or ``skip``). Columns below the approval confidence stay open unless ``approve_all``.
    """
    profile = infer_types(df, columns, order_by)
    if suggestions is not None:
        profile = reconcile_types(profile, suggestions)
    else:
        profile = profile.withColumn("user_approved", F.col("confidence") >= APPROVAL_CONFIDENCE)
    rows = profile.orderBy("column_index").select(
        "column_name", "inferred_type", "user_approved", "all_integral"
    ).collect()
    corrections = corrections or {}
    decisions = {}
    for r in rows:
        fix = corrections.get(r["column_name"])
        approved = bool(r["user_approved"]) or approve_all
        kept = fix if fix and fix != SKIP else r["inferred_type"]
        decisions[r["column_name"]] = ColumnDecision(kept, approved and fix is None, fix)
    return decisions, {r["column_name"] for r in rows if r["all_integral"]}


def decide_by_source(
    df: DataFrame, columns: Sequence[str], source: str, order_by: Sequence[str] | None = None
) -> dict[str, dict[object, tuple[str | None, bool]]]:
    """Types of the text columns of stacked tables, each source by itself: column to source to target
    (None if the confidence is low) and whether all its numbers are integers."""
    profile = infer_types(df, columns, order_by, by=[source])
    # one row per source and column
    rows = profile.select(ref(source).alias("__source"), "column_name", "inferred_type", "confidence", "all_integral").collect()
    out: dict[str, dict[object, tuple[str | None, bool]]] = {c: {} for c in columns}
    for r in rows:
        target = r["inferred_type"] if r["confidence"] >= APPROVAL_CONFIDENCE else None
        out[r["column_name"]][r["__source"]] = (target, bool(r["all_integral"]))
    return out


def fit_plan(
    df: DataFrame,
    order_by: Sequence[str] | None = None,
    suggestions: DataFrame | None = None,
    corrections: dict[str, str] | None = None,
    drop_duplicates: bool | None = True,
    nil_actions: dict[str, str] | None = None,
    columns_to_drop: Sequence[str] = (),
    approve_all: bool = False,
    columns: Sequence[str] | None = None,
) -> CleaningPlan:
    """Derive a plan from the first table; every answer a person would give is an argument."""
    decisions, integral = decide_columns(
        df, columns, order_by, suggestions, corrections, approve_all
    )
    plan = CleaningPlan(
        decisions,
        drop_duplicates,
        dict(nil_actions or {}),
        [c for c in columns_to_drop if c in df.columns],
        sorted(integral),
    )
    plan.check(new=True)
    plan.levels, plan.level_table = category_values(df, [c for c, d in decisions.items() if d.target == "categorical"])
    return plan


LEVELS = "column_name string, value string"


def category_values(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, list[str]], DataFrame | None]:
    """The non-empty values of categorical text columns: in order for columns that have at most ``LISTED_LEVELS``,
    and a table of those of the others."""
    if not columns:
        return {}, None
    values = unpivot_as(df, {c: ref(c).cast("string") for c in columns}).filter("value <> ''").distinct()
    written, _ = materialize(values.select("column_name", "value"), "levels")
    # one row per column
    many = [r["column_name"] for r in written.groupBy("column_name").count().filter(F.col("count") > LISTED_LEVELS).collect()]
    few = written.filter(~F.col("column_name").isin(many)) if many else written
    listed = few.groupBy("column_name").agg(F.array_sort(F.collect_set("value")).alias("v"))
    table = written.filter(F.col("column_name").isin(many)) if many else None
    return {r["column_name"]: list(r["v"]) for r in listed.collect()}, table
