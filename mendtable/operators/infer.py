"""Semantic type inference from value frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import group_join, local_table, quoted, ref, text_columns
from ..functions.parsing import (
    BOOLEAN_PAIRS,
    datetime_sql,
    finite_sql,
    fits_integer_sql,
    number_sql,
    strip_sql,
)
from .frequencies import first_values, text_frequencies

SEMANTIC_TYPES = ["integer", "float", "boolean", "datetime", "categorical", "text", "identifier"]

# Thresholds and confidences of the inference rules.
IDENTIFIER_RATIO, IDENTIFIER_CONFIDENCE = 0.95, 0.9
IDENTIFIER_NAME = "id|key"
BOOLEAN_CONFIDENCE = 0.95
NUMERIC_RATIO = 0.9
DATE_RATIO, DATE_SAMPLE = 0.8, 50
CATEGORY_RATIO, CATEGORY_LIMIT, CATEGORY_CONFIDENCE = 0.05, 20, 0.85
TEXT_CONFIDENCE = 0.7
APPROVAL_CONFIDENCE, DISAGREEMENT_CONFIDENCE = 0.8, 0.5
SAMPLES = 5


# The reason a profile gives for each type, as format strings.
REASONS = {
    "empty": "All %d values are empty or missing. Defaulting to text.",
    "identifier": "Column name suggests ID, high uniqueness: %s.",
    "boolean": "Contains only boolean-like values: %s.",
    "integer": "%s are valid integers.",
    "float": "%s are valid numbers with decimals.",
    "datetime": "%s of sample values parse as dates.",
    "categorical": "Low cardinality: %d unique values (%s).",
    "text": "High cardinality text: %d unique values.",
}


def _reason(name: str, *values: str) -> str:
    return f"format_string('{REASONS[name]}', {', '.join(values)})"


def _percent_sql(ratio: str) -> str:
    return f"format_string('%.1f%%', {ratio} * 100)"


def column_facts(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Counts per text column that the inference rules read, from one frequency shuffle."""
    columns = list(columns or text_columns(df, skip=by))
    keys = [ref(b) for b in by]
    words = ", ".join(f"'{w}'" for pair in BOOLEAN_PAIRS for w in pair)
    word = strip_sql("lower(value)")
    freq = text_frequencies(
        df,
        columns,
        {"num": number_sql("value"), "word": f"CASE WHEN {word} IN ({words}) THEN {word} ELSE '' END"},
        by,
    )
    pairs = " OR ".join(
        f"coalesce(bool_and(CASE WHEN token <> '' THEN word IN ('{a}', '{b}') END), false)"
        for a, b in BOOLEAN_PAIRS
    )
    finite = finite_sql("num")
    facts = freq.groupBy(*keys, "column_name").agg(
        F.expr("sum(cnt) AS total"),
        F.expr("coalesce(sum(CASE WHEN token <> '' THEN cnt END), 0) AS non_empty"),
        F.expr("count(1) AS unique_count"),
        F.expr("coalesce(sum(CASE WHEN num IS NOT NULL THEN cnt END), 0) AS numeric_count"),
        F.expr(f"count_if({finite}) AS finite"),
        F.expr(f"count_if({finite} AND num <> rint(num)) AS fractional"),
        F.expr(f"count_if(num IS NOT NULL AND NOT {fits_integer_sql('num')}) AS not_integer"),
        F.expr(f"({pairs}) AS is_boolean"),
        F.expr("array_sort(collect_set(nullif(word, ''))) AS words"),
    )
    spark = df.sparkSession
    order = local_table(spark, list(enumerate(columns)), "column_index int, column_name string")
    if by:
        return facts.join(F.broadcast(order), "column_name")
    # one row per column on either side
    filled = order.join(F.broadcast(facts), "column_name", "left")
    counts = ["total", "non_empty", "unique_count", "numeric_count", "finite", "fractional", "not_integer"]
    return filled.fillna(0, counts).fillna(False, ["is_boolean"])


def infer_types(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    by: Sequence[str] = (),
    samples: int = SAMPLES,
) -> DataFrame:
    """One profile row per text column (and per ``by`` group).

    Columns: ``column_index``, ``column_name``, ``inferred_type``, ``reasoning``,
    ``sample_values``, ``confidence``, the review fields (unset), and the counts the decision was
    made from. ``order_by`` says which rows come first for the date test and the samples.
    """
    skip = [*by, *(order_by or ())]
    columns = list(columns or text_columns(df, skip=skip))
    keys = [ref(b) for b in by]
    facts = column_facts(df, columns, by)
    shown = max(samples, DATE_SAMPLE)
    firsts = first_values(df, columns, shown, order_by, by)
    seen = firsts.groupBy(*keys, "column_name").agg(
        F.expr(f"count_if(place <= {DATE_SAMPLE} AND {datetime_sql('value')} IS NOT NULL) AS dates"),
        F.expr(f"count_if(place <= {DATE_SAMPLE}) AS date_sample"),
        F.expr(
            f"sort_array(collect_list(CASE WHEN place <= {samples} THEN struct(place, value) END)) AS firsts"
        ),
    )
    ratios = group_join(facts, seen, by, "left", ["column_name"]).selectExpr(
        "*",
        "coalesce(try_divide(unique_count, total), 0D) AS unique_ratio",
        "coalesce(try_divide(numeric_count, non_empty), 0D) AS numeric_ratio",
        "coalesce(try_divide(dates, date_sample), 0D) AS date_ratio",
    )
    whole = "(finite > 0 AND fractional = 0)"
    # rules in order: condition, type, confidence, reasoning
    rules = [
        (
            "non_empty = 0",
            "'text'",
            "1D",
            _reason("empty", "total"),
        ),
        (
            f"unique_ratio > {IDENTIFIER_RATIO}D AND lower(column_name) RLIKE '{IDENTIFIER_NAME}'",
            "'identifier'",
            f"{IDENTIFIER_CONFIDENCE}D",
            _reason("identifier", _percent_sql("unique_ratio")),
        ),
        (
            "is_boolean",
            "'boolean'",
            f"{BOOLEAN_CONFIDENCE}D",
            _reason("boolean", "array_join(words, ', ')"),
        ),
        (
            f"numeric_ratio > {NUMERIC_RATIO}D",
            f"CASE WHEN {whole} THEN 'integer' ELSE 'float' END",
            "numeric_ratio",
            f"CASE WHEN {whole} THEN {_reason('integer', _percent_sql('numeric_ratio'))}"
            f" ELSE {_reason('float', _percent_sql('numeric_ratio'))} END",
        ),
        (
            f"date_ratio > {DATE_RATIO}D",
            "'datetime'",
            "date_ratio",
            _reason("datetime", _percent_sql("date_ratio")),
        ),
        (
            f"unique_ratio < {CATEGORY_RATIO}D AND unique_count <= {CATEGORY_LIMIT}",
            "'categorical'",
            f"{CATEGORY_CONFIDENCE}D",
            _reason("categorical", "unique_count", _percent_sql("unique_ratio")),
        ),
        (
            "true",
            "'text'",
            f"{TEXT_CONFIDENCE}D",
            _reason("text", "unique_count"),
        ),
    ]

    def choose(part: int) -> str:
        return "CASE " + " ".join(f"WHEN {rule[0]} THEN {rule[part]}" for rule in rules) + " END"

    return ratios.selectExpr(
        *[quoted(b) for b in by],
        "column_index",
        "column_name",
        f"{choose(1)} AS inferred_type",
        f"{choose(3)} AS reasoning",
        "coalesce(firsts.value, cast(array() AS array<string>)) AS sample_values",
        f"{choose(2)} AS confidence",
        "cast(NULL AS boolean) AS user_approved",
        "cast(NULL AS string) AS user_correction",
        "false AS transformation_applied",
        "total",
        "non_empty",
        "unique_count",
        "unique_ratio",
        "numeric_ratio",
        "date_ratio",
        "not_integer = 0 AS all_integral",
    )


def reconcile_types(profile: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Merge an outside opinion into a profile.

    ``suggestions`` has ``column_name``, ``suggested_type``, ``confidence`` and ``reasoning``.
    Agreement takes over the suggester's confidence; disagreement keeps the rule's type at 0.5.
    Confidence of at least 0.8 approves the column, anything lower leaves it open for review.
    """
    s = suggestions.select(
        "column_name",
        "suggested_type",
        F.col("confidence").alias("__confidence"),
        F.col("reasoning").alias("__reasoning"),
    )
    agrees = F.col("suggested_type") == F.col("inferred_type")
    confidence = (
        F.when(F.col("suggested_type").isNull(), F.col("confidence"))
        .when(agrees, F.col("__confidence"))
        .otherwise(F.lit(DISAGREEMENT_CONFIDENCE))
    )
    reasoning = (
        F.when(F.col("suggested_type").isNull(), F.col("reasoning"))
        .when(agrees, F.concat("reasoning", F.lit(" Confirmed: "), "__reasoning"))
        .otherwise(
            F.concat(
                F.lit("Disagreement: rules say "),
                "inferred_type",
                F.lit(", suggestion is "),
                "suggested_type",
                F.lit(" - "),
                "__reasoning",
            )
        )
    )
    joined = profile.join(s, "column_name", "left")
    return joined.withColumns(
        {
            "reasoning": reasoning,
            "confidence": confidence,
            "user_approved": F.when(confidence >= APPROVAL_CONFIDENCE, F.lit(True)).otherwise(
                F.col("user_approved")
            ),
            "needs_review": confidence < APPROVAL_CONFIDENCE,
        }
    ).drop("__confidence", "__reasoning")


def resolve_target_type(profile: DataFrame) -> DataFrame:
    """Add ``target_type``: the correction, else the approved type, else null for untouched."""
    target = (
        F.when(F.col("user_correction") == "skip", F.lit(None))
        .when(F.col("user_correction").isNotNull(), F.col("user_correction"))
        .when(F.col("user_approved"), F.col("inferred_type"))
    )
    return profile.withColumn("target_type", target.cast("string"))
