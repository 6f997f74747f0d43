"""Pieces of the comparison SQL that several queries share."""

from __future__ import annotations

from collections.abc import Sequence

from . import fixtures as fx

SPACE = r"[ \t\n\x0b\f\r]"
NUMBER = rf"^{SPACE}*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?{SPACE}*$"
BOOLEAN_PAIRS = [("t", "f"), ("true", "false"), ("yes", "no"), ("y", "n"), ("0", "1")]
DATE_FORMATS = [
    "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y", "%d %B %Y", "%Y%m%d",
]


def strip(v: str) -> str:
    return rf"regexp_replace({v}, '^\s+|\s+$', '', 'g')"


def nil_text(v: str) -> str:
    return f"({v} IS NULL OR {strip(v)} = '' OR lower({v}) = 'nan')"


def number(v: str) -> str:
    parsed = f"TRY_CAST(regexp_replace({strip(v)}, '^[+]', '') AS DOUBLE)"
    return (
        f"CASE WHEN regexp_matches({v}, '{NUMBER}') AND isfinite({parsed}) THEN {parsed}"
        f" WHEN lower({v}) IN ('inf','+inf','infinity','+infinity') THEN CAST('inf' AS DOUBLE)"
        f" WHEN lower({v}) IN ('-inf','-infinity') THEN CAST('-inf' AS DOUBLE) END"
    )


def date(v: str, formats: Sequence[str] = DATE_FORMATS) -> str:
    tries = ", ".join(f"try_strptime({v}, '{f}')" for f in formats)
    return f"CAST(coalesce({tries}) AS TIMESTAMP)"


def boolean(v: str) -> str:
    word = f"lower({strip(v)})"
    return (
        f"CASE WHEN {word} IN ('t','true','yes','y','1') THEN true"
        f" WHEN {word} IN ('f','false','no','n','0') THEN false END"
    )


def currency(v: str) -> str:
    return number(f"regexp_replace({v}, '[$€£¥₹,]', '', 'g')")


def with_(name: str, body: str, rest: str) -> str:
    return f"WITH {name} AS ({body}) {rest}"


def profile(source: str, columns: Sequence[str], order: str, keep: str = "*") -> str:
    """Inference as one SELECT per column over ``source``; ``order`` sorts the rows."""
    parts = []
    for i, c in enumerate(columns):
        num = number(c)
        word = f"lower({strip(c)})"
        pairs = " OR ".join(
            f"coalesce(bool_and({word} IN ('{a}','{b}')) FILTER (WHERE {c} <> ''), false)"
            for a, b in BOOLEAN_PAIRS
        )
        ordered = order.format(c=c)
        parts.append(f"""
  SELECT {i} AS column_index, '{c}' AS column_name, f.*, d.* FROM (
    SELECT count(*) AS total, count(*) FILTER (WHERE {c} <> '') AS non_empty,
      count(DISTINCT {c}) AS unique_count,
      count(*) FILTER (WHERE {c} <> '' AND {num} IS NOT NULL) AS numeric_count,
      count(*) FILTER (WHERE isfinite({num})) AS finite,
      count(*) FILTER (WHERE isfinite({num}) AND {num} <> round_even({num}, 0)) AS fractional,
      {pairs} AS is_boolean,
      array_to_string(list_sort(list_distinct(list({word}) FILTER (WHERE {c} <> '' AND {word} IN
        ('t','f','true','false','yes','no','y','n','0','1')))), ', ') AS words
    FROM {source}) f,
  (SELECT count({date('v')}) AS dates, count(*) AS date_sample,
      coalesce(array_to_string(list(v ORDER BY place) FILTER (WHERE place <= 5), ' | '), '') AS samples
    FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {ordered}) AS place FROM {source} WHERE {c} <> '')
    WHERE place <= 50) d""")
    facts = " UNION ALL ".join(parts)
    ratio = "CASE WHEN total = 0 THEN 0 ELSE unique_count / total END"
    numeric = "CASE WHEN non_empty = 0 THEN 0 ELSE numeric_count / non_empty END"
    dates = "CASE WHEN date_sample = 0 THEN 0 ELSE dates / date_sample END"
    pct = "printf('%.1f%%', {} * 100)"
    return f"""SELECT {keep} FROM (
SELECT column_index, column_name, unique_count, samples,
  CASE WHEN non_empty = 0 THEN 'text'
    WHEN ur > 0.95 AND (contains(lower(column_name), 'id') OR contains(lower(column_name), 'key')) THEN 'identifier'
    WHEN is_boolean THEN 'boolean'
    WHEN nr > 0.9 THEN CASE WHEN finite > 0 AND fractional = 0 THEN 'integer' ELSE 'float' END
    WHEN dr > 0.8 THEN 'datetime'
    WHEN ur < 0.05 AND unique_count <= 20 THEN 'categorical' ELSE 'text' END AS inferred_type,
  round_even(CASE WHEN non_empty = 0 THEN 1.0
    WHEN ur > 0.95 AND (contains(lower(column_name), 'id') OR contains(lower(column_name), 'key')) THEN 0.9
    WHEN is_boolean THEN 0.95 WHEN nr > 0.9 THEN nr WHEN dr > 0.8 THEN dr
    WHEN ur < 0.05 AND unique_count <= 20 THEN 0.85 ELSE 0.7 END, 6) AS confidence,
  CASE WHEN non_empty = 0 THEN 'All ' || total || ' values are empty or missing. Defaulting to text.'
    WHEN ur > 0.95 AND (contains(lower(column_name), 'id') OR contains(lower(column_name), 'key'))
      THEN 'Column name suggests ID, high uniqueness: ' || {pct.format('ur')} || '.'
    WHEN is_boolean THEN 'Contains only boolean-like values: ' || words || '.'
    WHEN nr > 0.9 THEN {pct.format('nr')} || CASE WHEN finite > 0 AND fractional = 0
      THEN ' are valid integers.' ELSE ' are valid numbers with decimals.' END
    WHEN dr > 0.8 THEN {pct.format('dr')} || ' of sample values parse as dates.'
    WHEN ur < 0.05 AND unique_count <= 20
      THEN 'Low cardinality: ' || unique_count || ' unique values (' || {pct.format('ur')} || ').'
    ELSE 'High cardinality text: ' || unique_count || ' unique values.' END AS reasoning
FROM (SELECT *, {ratio} AS ur, {numeric} AS nr, {dates} AS dr FROM ({facts})))"""


def quartiles(source: str, columns: Sequence[str], group: str | None = None) -> str:
    """One row per column (and group): quartiles, fences and moments."""
    parts = []
    for c in columns:
        key = f"{group}, " if group else ""
        tail = f" GROUP BY {group}" if group else ""
        parts.append(
            f"SELECT {key}'{c}' AS column_name, quantile_cont({c}, 0.25) AS q1,"
            f" quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3,"
            f" min({c}) AS mn, max({c}) AS mx, avg({c}) AS mean, stddev_samp({c}) AS std,"
            f" count({c}) AS n FROM (SELECT {key}CAST({c} AS DOUBLE) AS {c} FROM {source}){tail}"
        )
    return (
        "SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


CLEAN_MESSY_SQL = f"""
SELECT order_id, status,
  {currency('price')} AS price, {number('amount')} AS amount, {boolean('is_urgent')} AS is_urgent,
  {date('order_date')} AS order_date, priority
FROM ({fx.MESSY_ORDERS_SQL})"""
