"""One query per operator over whole tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendtable.functions import parsing
from mendtable.functions.columns import ref
from mendtable.operators import casts, charts, duplicates, infer, nils, profiles, selection, statistics, summaries
from mendtable.operators.frequencies import first_values
from mendtable.plans import pipeline, report
from mendtable.plans.plan import CleaningPlan, ColumnDecision, fit_plan, load_plan, save_plan
from mendtable.sources import json_text, logs, tables
from mendtable.sources.snapshots import read_snapshot
from mendtable.sources.workspace import scratch_path

from . import fixtures as fx
from . import sql
from .fixtures import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register


def rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.bround(ref(c), digits) for c in columns})


# --------------------------------------------------------------------------- sources and sinks


@query(
    "read_text_table",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars"
    " FROM documents",
)
def _(spark, d):
    path = scratch_path(spark, "documents") + ".csv"
    docs = table(spark, d, "documents").select(
        F.col("doc_id").cast("string"), "text", "lang", "source", F.col("n_chars").cast("string")
    )
    docs.write.options(
        header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return tables.read_text_table(spark, path)


@query(
    "read_snapshot_as_text",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,"
    " CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,"
    " o_orderpriority FROM orders",
)
def _(spark, d):
    return tables.read_snapshot_as_text(spark, f"{d}/orders.parquet")


_STEM = "regexp_extract(file_path, '([^/]*)[.][^.]*$', 1)"
_LABEL_SQL = f"""
SELECT o_orderkey, file_path, CASE WHEN files > 1 THEN string_split(file_path, '/')[-2] ELSE {_STEM} END AS source_file
FROM ({fx.FILE_ROWS_SQL}) JOIN (SELECT stem, count(*) AS files FROM
  (SELECT DISTINCT file_path AS p, {_STEM} AS stem FROM ({fx.FILE_ROWS_SQL})) GROUP BY stem) ON stem = {_STEM}"""


@query("source_label", _LABEL_SQL)
def _(spark, d):
    return tables.label_sources(fx.file_rows(spark, d), "file_path")


@query("with_source_column", "SELECT *, 'all_orders' AS source_file FROM orders")
def _(spark, d):
    return selection.with_source_column(table(spark, d, "orders"), "all_orders")


_MESSY_TYPES = {
    "order_id": "identifier", "status": "categorical", "price": "currency", "amount": "float",
    "is_urgent": "boolean", "order_date": "datetime", "priority": "text",
}


@query("write_typed_snapshot", sql.CLEAN_MESSY_SQL)
def _(spark, d):
    typed = casts.apply_casts(fx.messy_orders(spark, d).drop("o_orderkey"), _MESSY_TYPES)
    folder = scratch_path(spark, "snapshots")
    # the second version takes the place of the first
    tables.write_typed_snapshot(typed.filter("status IS NULL"), folder, "orders")
    tables.write_typed_snapshot(typed, folder, "orders")
    return read_snapshot(spark, tables.snapshot_path(folder, "orders", "transformed"))


@query(
    "write_cleaned_snapshot",
    f"SELECT doc_id, lang, n_chars, source, source_file FROM ({fx.STACKED_DOCUMENTS_SQL})",
)
def _(spark, d):
    stacked = fx.stacked_documents(spark, d)
    folder = scratch_path(spark, "snapshots")
    tables.write_cleaned_snapshot(stacked, folder, "docs", ["source_file"])
    back = read_snapshot(spark, tables.snapshot_path(folder, "docs", "cleaned"))
    return back.select(stacked.columns)


_MESSY_CORRECTIONS = {"price": "currency", "amount": "float", "priority": "skip"}
_MESSY_NILS = {
    "status": "fill_most_common", "amount": "fill_median", "priority": "drop_rows", "is_urgent": "leave_empty",
}


def _messy_plan(spark, d) -> CleaningPlan:
    return fit_plan(
        fx.messy_orders(spark, d),
        ["o_orderkey"],
        corrections=_MESSY_CORRECTIONS,
        nil_actions=_MESSY_NILS,
        columns_to_drop=["is_urgent", "no_such_column"],
    )


def _plan_rows(spark, plan: CleaningPlan) -> DataFrame:
    return plan.to_df(spark).select(F.explode("stored_column_decisions")).select(
        F.col("key").alias("column_name"), "value.type", "value.approved", "value.correction"
    )


_PLAN_SQL = sql.with_(
    "t",
    fx.MESSY_ORDERS_SQL,
    "SELECT column_name, CASE column_name WHEN 'price' THEN 'currency' WHEN 'amount' THEN 'float'"
    " ELSE inferred_type END AS type,"
    " confidence >= 0.8 AND column_name NOT IN ('price', 'amount', 'priority') AS approved,"
    " CASE column_name WHEN 'price' THEN 'currency' WHEN 'amount' THEN 'float' WHEN 'priority' THEN 'skip' END"
    " AS correction FROM (" + sql.profile("t", fx.MESSY_COLUMNS, "o_orderkey") + ")",
)


@query("fit_plan", _PLAN_SQL)
def _(spark, d):
    return _plan_rows(spark, _messy_plan(spark, d))


def _saved_plan(spark, d) -> CleaningPlan:
    path = scratch_path(spark, "plan")
    save_plan(_messy_plan(spark, d), spark, path)
    return load_plan(spark, path)


@query("save_plan", _PLAN_SQL)
def _(spark, d):
    path = scratch_path(spark, "plan")
    save_plan(_messy_plan(spark, d), spark, path)
    return spark.read.schema("stored_column_decisions map<string,struct<type:string,approved:boolean,correction:string>>").json(
        path
    ).select(F.explode("stored_column_decisions")).select(
        F.col("key").alias("column_name"), "value.type", "value.approved", "value.correction"
    )


@query("load_plan", _PLAN_SQL)
def _(spark, d):
    return _plan_rows(spark, _saved_plan(spark, d))


_LOG_SQL = f"""WITH typed AS (SELECT DISTINCT * FROM ({sql.CLEAN_MESSY_SQL})),
m AS (SELECT status FROM typed WHERE status <> '' GROUP BY status ORDER BY count(*) DESC, status LIMIT 1),
parts AS (
  SELECT 0 AS seq, 'Kept ''order_id'' as identifier (string)' AS message
  UNION ALL SELECT 1, 'Converted ''status'' to categorical'
  UNION ALL SELECT 2, 'Converted ''price'' to numeric (currency symbols removed)'
  UNION ALL SELECT 3, 'Converted ''amount'' to float'
  UNION ALL SELECT 4, 'Converted ''is_urgent'' to boolean'
  UNION ALL SELECT 5, 'Converted ''order_date'' to datetime'
  UNION ALL SELECT 6, CASE WHEN (SELECT count(*) FROM ({sql.CLEAN_MESSY_SQL})) = (SELECT count(*) FROM typed)
    THEN 'No duplicate rows found' ELSE 'duplicates' END
  UNION ALL SELECT 7, concat('Filled ', (SELECT count(*) FROM typed WHERE status = ''),
    ' nil values in ''status'' with most common value (''', (SELECT status FROM m), ''')')
  UNION ALL SELECT 8, concat('Filled ', (SELECT count(*) FROM typed WHERE amount IS NULL),
    ' nil values in ''amount'' with median (', (SELECT quantile_cont(amount, 0.5) FROM typed), ')')
  UNION ALL SELECT 9, 'No nil values in ''is_urgent'''
  UNION ALL SELECT 10, concat('Dropped ', (SELECT count(*) FROM typed WHERE {sql.nil_text('priority')}),
    ' rows with nil values in ''priority''')
  UNION ALL SELECT 11, 'Dropped columns: [''is_urgent'']')
SELECT seq, 1 AS file_number, concat('[File 1] ', message) AS message FROM parts"""


@query("processing_log", _LOG_SQL)
def _(spark, d):
    done = pipeline.clean_table(fx.messy_orders(spark, d), _messy_plan(spark, d), ["o_orderkey"])
    return done.log.to_df(spark)


@query("log_head", f"SELECT *, CAST(4 AS BIGINT) AS more FROM ({_LOG_SQL}) WHERE seq < 8")
def _(spark, d):
    done = pipeline.clean_table(fx.messy_orders(spark, d), _messy_plan(spark, d), ["o_orderkey"])
    return logs.log_head(done.log.to_df(spark))


@query(
    "rows_as_json",
    "SELECT CAST(json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus, 'o_orderdate',"
    " strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 'priority',"
    " CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END) AS VARCHAR) AS row_json FROM orders",
)
def _(spark, d):
    orders = table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderdate",
        "case when o_orderkey % 7 <> 0 then o_orderpriority end as priority",
    )
    return json_text.rows_as_json(orders)


_CLEAN_PIECE = (
    "CASE WHEN starts_with(" + sql.strip("x") + ", 'json') THEN " + sql.strip(f"{sql.strip('x')}[5:]")
    + " ELSE " + sql.strip("x") + " END"
)


@query(
    "extract_fenced_json",
    f"SELECT event_id, CASE WHEN contains(reply, '```') THEN list_filter(list_transform("
    f"string_split(reply, '```'), lambda x: {_CLEAN_PIECE}), lambda x: json_valid(x))[1]"
    f" WHEN json_valid(reply) THEN reply END AS json FROM ({fx.REPLIES_SQL})",
)
def _(spark, d):
    return json_text.extract_fenced_json(fx.replies(spark, d), "reply").select("event_id", "json")


# --------------------------------------------------------------------------- projections, filters


@query("filter_non_empty", f"SELECT order_id, status FROM ({fx.MESSY_ORDERS_SQL}) WHERE status <> ''")
def _(spark, d):
    return selection.filter_non_empty(fx.messy_orders(spark, d), "status").select("order_id", "status")


@query(
    "is_nil",
    f"SELECT order_id, {sql.nil_text('priority')} AS priority_nil, {sql.nil_text('status')} AS status_nil,"
    f" {sql.nil_text('amount')} AS amount_nil FROM ({fx.MESSY_ORDERS_SQL})",
)
def _(spark, d):
    t = fx.messy_orders(spark, d)
    return t.select("order_id", *[nils.nil(t, c).alias(f"{c}_nil") for c in ("priority", "status", "amount")])


@query(
    "drop_nil_rows",
    f"SELECT order_id, priority FROM ({fx.MESSY_ORDERS_SQL}) WHERE NOT {sql.nil_text('priority')}",
)
def _(spark, d):
    return nils.drop_nil_rows(fx.messy_orders(spark, d), "priority").select("order_id", "priority")


@query("drop_columns", "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders")
def _(spark, d):
    return selection.drop_columns(table(spark, d, "orders"), ["o_totalprice", "nowhere", "o_orderdate"])


@query(
    "project_required",
    f"SELECT source_file, n_chars, doc_id, source FROM ({fx.STACKED_DOCUMENTS_SQL})",
)
def _(spark, d):
    return selection.project_required(
        fx.stacked_documents(spark, d), ["n_chars", "nowhere", "doc_id", "n_chars"], "source"
    )


@query(
    "project_required_fallback",
    "SELECT 'all' AS source_file, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,"
    " l_extendedprice, l_discount, l_tax FROM lineitem",
)
def _(spark, d):
    stacked = selection.with_source_column(table(spark, d, "lineitem"), "all")
    return selection.project_required(stacked, ["nowhere"])


@query(
    "select_numeric",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax"
    " FROM lineitem",
)
def _(spark, d):
    flagged = table(spark, d, "lineitem").withColumn("late", F.col("l_shipdate") > "1998-01-01")
    return selection.select_numeric(flagged)


@query("select_first_n_numeric", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def _(spark, d):
    return selection.select_first_n_numeric(table(spark, d, "lineitem"))


@query(
    "iqr_outlier_rows",
    f"SELECT event_id, event_type, value FROM events, ({sql.quartiles('events', ['value'])}) q"
    " WHERE value < q.lower OR value > q.upper",
)
def _(spark, d):
    return statistics.iqr_outlier_rows(table(spark, d, "events"), "value").select("event_id", "event_type", "value")


@query(
    "iqr_outlier_rows_by_group",
    f"SELECT event_id, event_type, value FROM events JOIN ({sql.quartiles('events', ['value'], 'event_type')}) q"
    " USING (event_type) WHERE value < q.lower OR value > q.upper",
)
def _(spark, d):
    return statistics.iqr_outlier_rows(table(spark, d, "events"), "value", ["event_type"]).select(
        "event_id", "event_type", "value"
    )


# --------------------------------------------------------------------------- type inference

_PROFILE_KEEP = "column_index, column_name, inferred_type, confidence, reasoning, samples, unique_count"


def _profile_out(profile: DataFrame) -> DataFrame:
    return profile.select(
        "column_index", "column_name", "inferred_type", F.bround("confidence", 6).alias("confidence"),
        "reasoning", F.array_join("sample_values", " | ").alias("samples"), "unique_count",
    )


@query(
    "infer_types",
    sql.with_("t", fx.MESSY_ORDERS_SQL, sql.profile("t", fx.MESSY_COLUMNS, "o_orderkey", _PROFILE_KEEP)),
)
def _(spark, d):
    return _profile_out(infer.infer_types(fx.messy_orders(spark, d), order_by=["o_orderkey"]))


@query(
    "infer_types_default_order",
    sql.with_(
        "t",
        "SELECT text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars, CAST(doc_id AS VARCHAR) AS doc_id"
        " FROM documents",
        sql.profile("t", ["text", "lang", "source", "n_chars", "doc_id"], "md5({c}), {c}", _PROFILE_KEEP),
    ),
)
def _(spark, d):
    docs = table(spark, d, "documents").select(
        "text", "lang", "source", F.col("n_chars").cast("string"), F.col("doc_id").cast("string")
    )
    return _profile_out(infer.infer_types(docs))


def _rule_query(name: str, columns: list[str]) -> None:
    @query(
        name,
        sql.with_("t", fx.RULE_COLUMNS_SQL, sql.profile("t", columns, "o_orderkey", _PROFILE_KEEP)),
    )
    def _(spark, d):
        return _profile_out(
            infer.infer_types(fx.rule_columns(spark, d), columns=columns, order_by=["o_orderkey"])
        )


_rule_query("infer_empty", ["empty_column"])
_rule_query("infer_identifier", ["order_id", "order_number"])
_rule_query("infer_boolean", ["answer", "mixed_answer"])
_rule_query("infer_numeric_ratio", ["nine_tenths", "above_nine_tenths"])
_rule_query("infer_integer_vs_float", ["whole_number", "decimal_number"])
_rule_query("infer_datetime", ["any_date", "four_fifths_date"])
_rule_query("infer_categorical", ["twenty_values", "twenty_one_values"])
_rule_query("infer_text_default", ["remark", "twenty_one_values"])


@query(
    "sample_values",
    "SELECT column_name, CAST(place AS INTEGER) AS place, value FROM (SELECT *, row_number() OVER (PARTITION BY column_name"
    " ORDER BY o_orderkey) AS place FROM (UNPIVOT (" + fx.MESSY_ORDERS_SQL + ") ON order_id, status, price,"
    " amount, is_urgent, order_date, priority INTO NAME column_name VALUE value) WHERE value <> '')"
    " WHERE place <= 5",
)
def _(spark, d):
    return first_values(fx.messy_orders(spark, d), fx.MESSY_COLUMNS, 5, ["o_orderkey"])


_SUGGESTION = "CASE WHEN unique_count > 1000 THEN 'text' ELSE inferred_type END"
_SUGGESTED = "CASE WHEN column_index % 2 = 0 THEN 0.75 ELSE 0.9 END"


def _reconciled(spark, d) -> DataFrame:
    profile = infer.infer_types(fx.messy_orders(spark, d), order_by=["o_orderkey"])
    suggestions = profile.select(
        "column_name",
        F.expr(_SUGGESTION).alias("suggested_type"),
        F.expr(_SUGGESTED).cast("double").alias("confidence"),
        F.lit("looks so").alias("reasoning"),
    )
    return infer.reconcile_types(profile, suggestions)


_RECONCILE_SQL = sql.with_(
    "t",
    fx.MESSY_ORDERS_SQL,
    f"SELECT column_name, inferred_type, CASE WHEN s = inferred_type THEN c ELSE 0.5 END AS confidence,"
    f" CASE WHEN s = inferred_type AND c >= 0.8 THEN true END AS user_approved FROM"
    f" (SELECT *, {_SUGGESTION} AS s, CAST({_SUGGESTED} AS DOUBLE) AS c"
    f" FROM ({sql.profile('t', fx.MESSY_COLUMNS, 'o_orderkey')}))",
)


@query("reconcile_types", _RECONCILE_SQL)
def _(spark, d):
    return _reconciled(spark, d).select("column_name", "inferred_type", "confidence", "user_approved")


@query(
    "resolve_target_type",
    "SELECT column_name, CASE WHEN column_name = 'status' THEN NULL WHEN column_name = 'price' THEN 'currency'"
    f" WHEN user_approved THEN inferred_type END AS target_type FROM ({_RECONCILE_SQL})",
)
def _(spark, d):
    reviewed = _reconciled(spark, d).withColumn(
        "user_correction", F.expr("case column_name when 'status' then 'skip' when 'price' then 'currency' end")
    )
    return infer.resolve_target_type(reviewed).select("column_name", "target_type")


# --------------------------------------------------------------------------- casts


def _cast_query(name: str, column: str, target: str, expression: str) -> None:
    @query(name, f"SELECT o_orderkey, {expression} AS {column} FROM ({fx.CAST_COLUMNS_SQL})")
    def _(spark, d):
        t = fx.cast_columns(spark, d).select("o_orderkey", column)
        return casts.apply_casts(t, {column: target})


_INTEGER_SQL = (
    f"CASE WHEN regexp_matches(whole, '{sql.NUMBER}') THEN"
    f" coalesce(CASE WHEN regexp_matches({sql.strip('whole')}, '^[+-]?[0-9]+$') THEN"
    f" TRY_CAST({sql.strip('whole')} AS BIGINT) END,"
    f" CAST({sql.number('whole')} AS BIGINT)) END"
)
_cast_query("cast_integer", "whole", "integer", _INTEGER_SQL)
_cast_query("cast_integer_refused", "part", "integer", "part")
_cast_query("cast_float", "part", "float", sql.number("part"))
_cast_query("cast_boolean", "flag", "boolean", sql.boolean("flag"))
_cast_query("cast_datetime", "stamp", "datetime", sql.date("stamp"))
_cast_query("cast_categorical", "flag", "categorical", "flag")
_cast_query("cast_currency", "money", "currency", sql.currency("money"))
_cast_query("cast_text", "money", "text", "money")
_cast_query("cast_identifier", "code", "identifier", "code")


@query("apply_casts", sql.CLEAN_MESSY_SQL)
def _(spark, d):
    return casts.apply_casts(fx.messy_orders(spark, d).drop("o_orderkey"), _MESSY_TYPES | {"ghost": "float"})


@query(
    "to_number",
    f"SELECT o_orderkey, {sql.number('whole')} AS whole, {sql.number('part')} AS part"
    f" FROM ({fx.CAST_COLUMNS_SQL})",
)
def _(spark, d):
    t = fx.cast_columns(spark, d)
    return t.select("o_orderkey", *[parsing.to_number(c).alias(c) for c in ("whole", "part")])


@query(
    "normalize_token",
    f"SELECT o_orderkey, lower({sql.strip('flag')}) AS token FROM ({fx.CAST_COLUMNS_SQL})",
)
def _(spark, d):
    return fx.cast_columns(spark, d).select("o_orderkey", parsing.normalize_token("flag").alias("token"))


@query(
    "strip_currency",
    f"SELECT o_orderkey, regexp_replace(money, '[$€£¥₹,]', '', 'g') AS money FROM ({fx.CAST_COLUMNS_SQL})",
)
def _(spark, d):
    return fx.cast_columns(spark, d).select("o_orderkey", parsing.strip_currency("money").alias("money"))


@query(
    "path_stem_parent",
    f"SELECT o_orderkey, {_STEM} AS stem, string_split(file_path, '/')[-2] AS parent FROM ({fx.FILE_ROWS_SQL})",
)
def _(spark, d):
    p = "file_path"
    return fx.file_rows(spark, d).select(
        "o_orderkey", parsing.path_stem(p).alias("stem"), parsing.path_parent(p).alias("parent")
    )


@query(
    "iso_format",
    "SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    " ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts FROM events",
)
def _(spark, d):
    return table(spark, d, "events").select("event_id", parsing.iso_format(F.col("ts")).alias("ts"))


# --------------------------------------------------------------------------- duplicates

_DUP_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_DUP_GROUPS = f"SELECT {_DUP_COLUMNS}, count(*) AS cnt FROM ({fx.DUP_ORDERS_SQL}) GROUP BY {_DUP_COLUMNS}"


@query(
    "duplicate_count",
    "SELECT CAST(sum(cnt) AS BIGINT) AS total_rows, CAST(sum(cnt - 1) AS BIGINT) AS duplicate_count,"
    f" round_even(sum(cnt - 1) * 100.0 / sum(cnt), 2) AS duplicate_percent FROM ({_DUP_GROUPS})",
)
def _(spark, d):
    return duplicates.duplicate_count(fx.dup_orders(spark, d))


@query(
    "duplicate_count_text",
    "SELECT CAST(sum(cnt) AS BIGINT) AS total_rows, CAST(sum(cnt - 1) AS BIGINT) AS duplicate_count,"
    " round_even(sum(cnt - 1) * 100.0 / sum(cnt), 2) AS duplicate_percent FROM"
    " (SELECT count(*) AS cnt FROM documents GROUP BY text, lang)",
)
def _(spark, d):
    return duplicates.duplicate_count(table(spark, d, "documents").select("text", "lang"))


@query(
    "duplicate_rows",
    f"SELECT {_DUP_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY {_DUP_COLUMNS}) AS rn"
    f" FROM ({fx.DUP_ORDERS_SQL})) WHERE rn > 1",
)
def _(spark, d):
    return duplicates.duplicate_rows(fx.dup_orders(spark, d))


@query("drop_duplicates", f"SELECT DISTINCT * FROM ({fx.DUP_ORDERS_SQL})")
def _(spark, d):
    return duplicates.drop_duplicates(fx.dup_orders(spark, d))


@query("drop_duplicates_long_text", "SELECT DISTINCT text, lang FROM documents")
def _(spark, d):
    return duplicates.drop_duplicates(table(spark, d, "documents").select("text", "lang"), long_text=True)


# --------------------------------------------------------------------------- missing values


@query(
    "nil_report",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nil_count,"
        f" round_even(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS nil_percentage,"
        f" {'false' if c == 'l_returnflag' else 'true'} AS is_numeric FROM ({fx.SPARSE_LINEITEM_SQL})"
        for c in ("l_partkey", "l_quantity", "l_returnflag")
    ),
)
def _(spark, d):
    return nils.nil_report(fx.sparse_lineitem(spark, d))


@query(
    "nil_report_text",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {sql.nil_text(c)}) AS nil_count,"
        f" round_even(count(*) FILTER (WHERE {sql.nil_text(c)}) * 100.0 / count(*), 2) AS nil_percentage,"
        f" false AS is_numeric FROM ({fx.MESSY_ORDERS_SQL})"
        for c in fx.MESSY_COLUMNS
    )
    + ") WHERE nil_count > 0",
)
def _(spark, d):
    return nils.nil_report(fx.messy_orders(spark, d).drop("o_orderkey"))


def _fill_query(name: str, column: str, fit: Callable[[DataFrame, str], DataFrame], expression: str) -> None:
    @query(
        name,
        sql.with_(
            "t", fx.SPARSE_LINEITEM_SQL, f"SELECT l_orderkey, l_linenumber, l_extendedprice, {expression} AS {column} FROM t"
        ),
    )
    def _(spark, d):
        return fit(fx.sparse_lineitem(spark, d), column).select(
            "l_orderkey", "l_linenumber", "l_extendedprice", column
        )


_MODE_FLAG = (
    "(SELECT l_returnflag FROM t WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag"
    " ORDER BY count(*) DESC, l_returnflag LIMIT 1)"
)
_fill_query("fill_median", "l_quantity", nils.fill_median,
            "coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM t))")
_fill_query("fill_zero", "l_quantity", nils.fill_zero, "coalesce(l_quantity, 0)")
_fill_query("fill_unknown", "l_returnflag", nils.fill_unknown, "coalesce(l_returnflag, 'Unknown')")
_fill_query("fill_most_common", "l_returnflag", nils.fill_most_common, f"coalesce(l_returnflag, {_MODE_FLAG})")
_fill_query("leave_empty", "l_returnflag", nils.leave_empty, "l_returnflag")


@query(
    "fill_unknown_text",
    f"SELECT order_id, CASE WHEN {sql.nil_text('priority')} THEN 'Unknown' ELSE priority END AS priority"
    f" FROM ({fx.MESSY_ORDERS_SQL})",
)
def _(spark, d):
    return nils.fill_unknown(fx.messy_orders(spark, d), "priority").select("order_id", "priority")


@query(
    "mode_value",
    f"SELECT 'priority' AS column_name, priority AS mode_value FROM ({fx.MESSY_ORDERS_SQL})"
    f" WHERE NOT {sql.nil_text('priority')} GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1",
)
def _(spark, d):
    t = fx.messy_orders(spark, d)
    value = F.when(~nils.nil(t, "priority"), F.col("priority"))
    found = nils.most_common(t, {"priority": value}, {"priority": t.schema["priority"].dataType})
    return found.select("column_name", F.col("pair.txt").alias("mode_value"))


_REPAIR_SQL = f"""WITH t AS ({fx.SPARSE_LINEITEM_SQL}), kept AS (SELECT * FROM t WHERE l_quantity IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_extendedprice,
  CAST(coalesce(l_partkey, (SELECT quantile_cont(l_partkey, 0.5) FROM t)) AS DOUBLE) AS l_partkey, l_quantity,
  coalesce(l_returnflag, (SELECT l_returnflag FROM kept WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
    ORDER BY count(*) DESC, l_returnflag LIMIT 1)) AS l_returnflag
FROM kept"""


@query("repair_nils", _REPAIR_SQL)
def _(spark, d):
    t = fx.sparse_lineitem(spark, d)
    actions = {"l_returnflag": "fill_most_common", "l_quantity": "drop_rows", "l_partkey": "fill_median"}
    return nils.repair_nils(t, nils.fit_nils(t, actions)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_partkey").cast("double"), "l_quantity",
        "l_returnflag",
    )


@query(
    "repair_nils_by_group",
    f"""WITH t AS (SELECT *, l_linenumber AS grp FROM ({fx.SPARSE_LINEITEM_SQL})),
m AS (SELECT grp, quantile_cont(l_quantity, 0.5) AS med FROM t GROUP BY grp),
f AS (SELECT grp, l_returnflag AS flag, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, l_returnflag) AS rn
  FROM t WHERE l_returnflag IS NOT NULL GROUP BY grp, l_returnflag)
SELECT l_orderkey, l_linenumber, l_extendedprice, coalesce(l_quantity, med) AS l_quantity,
  coalesce(l_returnflag, flag) AS l_returnflag FROM t JOIN m USING (grp) JOIN f USING (grp) WHERE rn = 1""",
)
def _(spark, d):
    t = fx.sparse_lineitem(spark, d)
    fit = nils.fit_nils(t, {"l_quantity": "fill_median", "l_returnflag": "fill_most_common"}, ["l_linenumber"])
    return nils.repair_nils(t, fit).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag"
    )


# --------------------------------------------------------------------------- statistics

_LINE_NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


def _statistics_sql(source: str, types: dict[str, str], numeric: list[str], group: str | None = None) -> str:
    key, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    parts = []
    for c, t in types.items():
        same = f"q.{group} = c.{group} AND " if group else ""
        counts = (
            f"(SELECT {key}count({c}) AS non_null_count, count(*) - count({c}) AS null_count,"
            f" count(DISTINCT {c}) AS unique_count FROM {source}{tail}) c"
        )
        out = f"c.{group}, " if group else ""
        if c in numeric:
            inner = f"s.{group} = q.{group} AND " if group else ""
            parts.append(
                f"SELECT {out}'{c}' AS column_name, '{t}' AS dtype, non_null_count, null_count, unique_count,"
                f" mn AS min, mx AS max, round_even(median, 4) AS median, round_even(mean, 4) AS mean,"
                f" round_even(std, 4) AS std, (SELECT count(*) FROM {source} s WHERE {inner}"
                f"(s.{c} < q.lower OR s.{c} > q.upper)) AS outlier_count"
                f" FROM {counts} JOIN ({sql.quartiles(source, [c], group)}) q ON {same}true"
            )
        else:
            parts.append(
                f"SELECT {out}'{c}', '{t}', non_null_count, null_count, unique_count, NULL, NULL, NULL, NULL, NULL, 0"
                f" FROM {counts}"
            )
    return (
        "SELECT *, outlier_count > 0 AS has_outliers FROM (" + " UNION ALL ".join(parts) + ")"
    )


@query("column_statistics", _statistics_sql("lineitem", _LINE_TYPES, _LINE_NUMERIC))
def _(spark, d):
    out = statistics.column_statistics(table(spark, d, "lineitem")).drop("column_index")
    return rounded(out, ["median", "mean", "std"])


@query(
    "column_statistics_sparse",
    sql.with_(
        "t",
        fx.SPARSE_LINEITEM_SQL,
        _statistics_sql(
            "t",
            {c: _LINE_TYPES[c] for c in ("l_partkey", "l_quantity", "l_returnflag")},
            ["l_partkey", "l_quantity"],
        ),
    ),
)
def _(spark, d):
    t = fx.sparse_lineitem(spark, d)
    out = statistics.column_statistics(t, columns=["l_partkey", "l_quantity", "l_returnflag"])
    return rounded(out.drop("column_index"), ["median", "mean", "std"])


@query(
    "column_statistics_by_group",
    _statistics_sql(
        "events", {"value": "double", "user_id": "bigint", "props": "string"}, ["value", "user_id"], "event_type"
    ),
)
def _(spark, d):
    t = table(spark, d, "events").select("event_type", "value", "user_id", "props")
    out = statistics.column_statistics(t, by=["event_type"]).drop("column_index")
    return rounded(out, ["median", "mean", "std"])


@query("merged_profile", _statistics_sql("lineitem", _LINE_TYPES, _LINE_NUMERIC))
def _(spark, d):
    lines, path = table(spark, d, "lineitem"), scratch_path(spark, "profiles")
    for k in range(3):
        profiles.save_profile(lines.filter(F.col("l_orderkey") % 3 == k), path, f"part-{k}")
    # a file that comes again takes the place of its earlier state
    profiles.save_profile(lines.filter(F.col("l_orderkey") % 3 == 1), path, "part-1")
    return rounded(profiles.merged_statistics(spark, path).drop("column_index"), ["median", "mean", "std"])


@query("count_rows", "SELECT count(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM lineitem")
def _(spark, d):
    return statistics.shape(table(spark, d, "lineitem"))


@query(
    "count_distinct",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_count FROM lineitem" for c in _LINE_TYPES
    ),
)
def _(spark, d):
    return statistics.count_distinct(table(spark, d, "lineitem"))


@query(
    "null_percent",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round_even(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 1)"
        f" AS nulls_pct FROM ({fx.SPARSE_LINEITEM_SQL})"
        for c in ("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    ),
)
def _(spark, d):
    return statistics.null_percent(
        fx.sparse_lineitem(spark, d), ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    )


@query(
    "quartiles_iqr",
    "SELECT column_name, round_even(q1, 4) AS q1, round_even(q3, 4) AS q3, round_even(iqr, 4) AS iqr,"
    f" round_even(lower, 4) AS lower, round_even(upper, 4) AS upper FROM ({sql.quartiles('lineitem', _LINE_NUMERIC)})",
)
def _(spark, d):
    out = statistics.quartiles_iqr(table(spark, d, "lineitem")).drop("median")
    return rounded(out, ["q1", "q3", "iqr", "lower", "upper"])


@query(
    "outlier_count",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} < q.lower OR {c} > q.upper) AS outlier_count,"
        f" count(*) FILTER (WHERE {c} < q.lower OR {c} > q.upper) > 0 AS has_outliers"
        f" FROM events, ({sql.quartiles('events', [c])}) q"
        for c in ("event_id", "user_id", "value")
    ),
)
def _(spark, d):
    return statistics.outlier_count(table(spark, d, "events"))


_ORDERS_TYPES = {
    "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    "table_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, CAST(0 AS DOUBLE) AS nulls_pct,"
        f" (SELECT array_to_string(list(v ORDER BY o_orderkey), ' | ') FROM (SELECT CAST({c} AS VARCHAR) AS v,"
        f" o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5)) AS samples,"
        f" count(DISTINCT {c}) AS unique_count FROM orders"
        for c, t in _ORDERS_TYPES.items()
    ),
)
def _(spark, d):
    out = summaries.table_profile(table(spark, d, "orders"), order_by=["o_orderkey"])
    return out.select(
        "column_name", "dtype", "nulls_pct", F.array_join("sample_values", " | ").alias("samples"), "unique_count"
    )


@query(
    "profile_rows",
    "SELECT CAST(json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus, 'o_orderdate',"
    " strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')) AS VARCHAR) AS row_json FROM orders ORDER BY o_orderkey LIMIT 3",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return summaries.profile_rows(orders, ["o_orderkey"])


# --------------------------------------------------------------------------- per source

_STACKED_NUMERIC = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "source_summary",
    "SELECT source_file, count(*) AS row_count, "
    + ", ".join(f"round_even(avg({c}), 2) AS avg_{c}" for c in _STACKED_NUMERIC)
    + f" FROM ({fx.STACKED_LINEITEM_SQL}) GROUP BY source_file",
)
def _(spark, d):
    return summaries.source_summary(fx.stacked_lineitem(spark, d))


_DESCRIBE_SQL = (
    "SELECT source_file, column_name, round_even(mean, 2) AS mean, round_even(median, 2) AS median,"
    " round_even(mn, 2) AS min, round_even(mx, 2) AS max FROM ({})"
)


@query(
    "describe_by_source",
    sql.with_(
        "t",
        fx.STACKED_LINEITEM_SQL,
        _DESCRIBE_SQL.format(sql.quartiles("t", _STACKED_NUMERIC, "source_file")),
    ),
)
def _(spark, d):
    return summaries.describe_by_source(fx.stacked_lineitem(spark, d))


@query(
    "entity_stats",
    "SELECT source_file, " + ", ".join(f"round_even(avg({c}), 2) AS {c}" for c in _STACKED_NUMERIC)
    + f" FROM ({fx.STACKED_LINEITEM_SQL}) GROUP BY source_file",
)
def _(spark, d):
    return summaries.entity_stats(fx.stacked_lineitem(spark, d))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "crosstab_counts",
    "SELECT source_file, "
    + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIORITIES)
    + f" FROM ({fx.ORDER_SOURCES_SQL}) WHERE o_orderpriority IS NOT NULL GROUP BY source_file",
)
def _(spark, d):
    stacked = selection.union_sources(fx.order_sources(spark, d))
    return summaries.crosstab_counts(stacked, "o_orderpriority")


def _top_pairs_sql(source: str, key: str, group: str, n: int) -> str:
    return (
        f"WITH t AS ({source}), top AS (SELECT {group} FROM t WHERE {group} IS NOT NULL GROUP BY {group}"
        f" ORDER BY count(*) DESC, {group} LIMIT {n}), s AS (SELECT DISTINCT {key} FROM t WHERE {group} IS NOT NULL)"
        f" SELECT s.{key} AS source_file, top.{group} AS category, count(t.{group}) AS count FROM s CROSS JOIN top"
        f" LEFT JOIN t ON t.{key} = s.{key} AND t.{group} = top.{group} GROUP BY 1, 2"
    )


@query(
    "crosstab_top_categories",
    _top_pairs_sql("SELECT p_type AS source_file, p_brand FROM part", "source_file", "p_brand", 15),
)
def _(spark, d):
    parts = table(spark, d, "part").withColumnRenamed("p_type", "source_file")
    return summaries.crosstab_long(parts, "p_brand")


@query(
    "pivot_unstack",
    _top_pairs_sql(fx.STACKED_DOCUMENTS_SQL, "source_file", "source", 15),
)
def _(spark, d):
    wide = summaries.crosstab_counts(fx.stacked_documents(spark, d), "source")
    names = [c for c in wide.columns if c != "source_file"]
    return wide.unpivot("source_file", names, "category", "count")


@query(
    "value_counts",
    "SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand",
)
def _(spark, d):
    return selection.value_counts(table(spark, d, "part"), "p_brand")


@query("total_records", f"SELECT count(*) AS total_records FROM ({fx.ORDER_SOURCES_SQL})")
def _(spark, d):
    return summaries.total_records(selection.union_sources(fx.order_sources(spark, d)))


# --------------------------------------------------------------------------- heads and top n


@query(
    "head_per_source",
    "SELECT doc_id, lang, n_chars, source, source_file, CAST(place AS INTEGER) AS place, source_rows"
    " FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY doc_id) AS place, count(*) OVER (PARTITION BY source_file) AS source_rows"
    f" FROM ({fx.STACKED_DOCUMENTS_SQL})) WHERE place <= 10",
)
def _(spark, d):
    return selection.head_per_source(fx.stacked_documents(spark, d), ["doc_id"])


@query("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50")
def _(spark, d):
    return selection.head_n(table(spark, d, "orders"), 50, ["o_orderkey"])


@query(
    "top_n_columns_by_sum",
    _top_pairs_sql("SELECT p_type AS source_file, p_brand FROM part", "source_file", "p_brand", 8),
)
def _(spark, d):
    parts = table(spark, d, "part").withColumnRenamed("p_type", "source_file")
    wide = summaries.top_n_columns_by_sum(summaries.crosstab_counts(parts, "p_brand"), 8)
    return wide.unpivot("source_file", wide.columns[1:], "category", "count")


# --------------------------------------------------------------------------- stacking, reshaping


@query("union_sources", fx.ORDER_SOURCES_SQL)
def _(spark, d):
    return selection.union_sources(fx.order_sources(spark, d))


_FLAGS = ["flag_A", "flag_N", "flag_R"]


@query(
    "transpose_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS metric, "
        + ", ".join(f"round_even(avg({c}) FILTER (WHERE source_file = '{s}'), 2) AS {s}" for s in _FLAGS)
        + f" FROM ({fx.STACKED_LINEITEM_SQL})"
        for c in _STACKED_NUMERIC
    ),
)
def _(spark, d):
    return summaries.transpose_stats(summaries.entity_stats(fx.stacked_lineitem(spark, d)), _FLAGS)


# --------------------------------------------------------------------------- charts


def _chart_stats(spark, d) -> DataFrame:
    stacked = fx.stacked_lineitem(spark, d)
    return summaries.entity_stats(stacked).join(summaries.source_records(stacked), "source_file")


_STATS_SQL = (
    "SELECT source_file, count(*) AS records, "
    + ", ".join(f"round_even(avg({c}), 2) AS {c}" for c in _STACKED_NUMERIC)
    + f" FROM ({fx.STACKED_LINEITEM_SQL}) GROUP BY source_file"
)


@query(
    "chart_bar",
    "SELECT source_file, 'l_extendedprice' AS metric, 'L Extendedprice' AS label, l_extendedprice AS value"
    f" FROM ({_STATS_SQL})",
)
def _(spark, d):
    return charts.chart_data("bar", _chart_stats(spark, d), metric="l_extendedprice")


@query(
    "chart_default",
    "SELECT source_file, 'l_linenumber' AS metric, 'L Linenumber' AS label, CAST(l_linenumber AS DOUBLE) AS value"
    f" FROM ({_STATS_SQL})",
)
def _(spark, d):
    return charts.default_chart(_chart_stats(spark, d))


@query(
    "chart_grouped_bar",
    "SELECT source_file, category AS series, CAST(count AS DOUBLE) AS value FROM ("
    + _top_pairs_sql("SELECT p_type AS source_file, p_brand FROM part", "source_file", "p_brand", 8)
    + ")",
)
def _(spark, d):
    parts = table(spark, d, "part").withColumnRenamed("p_type", "source_file")
    return charts.chart_data("grouped_bar", None, breakdown=summaries.crosstab_counts(parts, "p_brand"))


@query(
    "chart_grouped_bar_fallback",
    " UNION ALL ".join(
        f"SELECT source_file, '{c}' AS series, CAST({c} AS DOUBLE) AS value FROM ({_STATS_SQL})"
        for c in _STACKED_NUMERIC[:4]
    ),
)
def _(spark, d):
    return charts.chart_data("grouped_bar", _chart_stats(spark, d))


@query(
    "chart_scatter",
    "SELECT source_file, l_quantity AS x, l_linenumber AS y, round_even(records * 1000.0 / greatest((SELECT"
    f" max(records) FROM ({_STATS_SQL})), 1), 4) AS size FROM ({_STATS_SQL})",
)
def _(spark, d):
    return rounded(charts.chart_data("scatter", _chart_stats(spark, d), x="l_quantity", y="nowhere"), ["size"])


@query(
    "chart_heatmap",
    " UNION ALL ".join(
        f"SELECT '{c}' AS metric, source_file, {c} AS value, round_even(({c} - (SELECT min({c}) FROM ({_STATS_SQL})))"
        f" / ((SELECT max({c}) - min({c}) FROM ({_STATS_SQL})) + 1e-9), 4) AS normalized FROM ({_STATS_SQL})"
        for c in _STACKED_NUMERIC
    ),
)
def _(spark, d):
    return rounded(charts.chart_data("heatmap", _chart_stats(spark, d)).drop("label"), ["normalized"])


_EVENT_SOURCES = "SELECT event_id, value, concat('events_', event_type) AS source_file FROM events"


def _event_sources(spark, d) -> DataFrame:
    return table(spark, d, "events").selectExpr(
        "event_id", "value", "concat('events_', event_type) as source_file"
    )


@query(
    "chart_box",
    f"WITH t AS ({_EVENT_SOURCES}), q AS ({sql.quartiles('t', ['value'], 'source_file')})"
    " SELECT source_file, least(min(value) FILTER (WHERE value >= q.lower), any_value(q1)) AS whisker_low,"
    " round_even(any_value(q1), 4) AS q1, round_even(any_value(median), 4) AS median,"
    " round_even(any_value(q3), 4) AS q3,"
    " greatest(max(value) FILTER (WHERE value <= q.upper), any_value(q3)) AS whisker_high,"
    " count(*) FILTER (WHERE value < q.lower OR value > q.upper) AS flier_count, count(*) AS n"
    " FROM t JOIN q USING (source_file) GROUP BY source_file",
)
def _(spark, d):
    out = charts.chart_data("boxplot", df=_event_sources(spark, d), metric="value")
    return rounded(out, ["q1", "median", "q3"])


@query(
    "chart_box_fliers",
    f"WITH t AS ({_EVENT_SOURCES}), q AS ({sql.quartiles('t', ['value'], 'source_file')})"
    " SELECT source_file, value FROM t JOIN q USING (source_file) WHERE value < q.lower OR value > q.upper",
)
def _(spark, d):
    return charts.chart_box_fliers(_event_sources(spark, d), "value")


@query(
    "chart_pie",
    "SELECT source_file, CAST(records AS DOUBLE) AS value, round_even(records * 100.0 / (SELECT sum(records)"
    f" FROM ({_STATS_SQL})), 1) AS percent FROM ({_STATS_SQL})",
)
def _(spark, d):
    return charts.chart_data("pie", _chart_stats(spark, d))


# --------------------------------------------------------------------------- pipelines

_CLEANED_SQL = f"""WITH typed AS (SELECT DISTINCT * FROM ({sql.CLEAN_MESSY_SQL})),
m AS (SELECT status FROM typed WHERE status <> '' GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)
SELECT order_id, CASE WHEN status = '' THEN (SELECT status FROM m) ELSE status END AS status, price,
  coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM typed)) AS amount, order_date, priority
FROM typed WHERE NOT {sql.nil_text('priority')}"""


@query("clean_table", _CLEANED_SQL)
def _(spark, d):
    messy = fx.messy_orders(spark, d)
    again = messy.unionAll(messy.filter("o_orderkey % 20 = 0"))
    return pipeline.clean_table(again, _messy_plan(spark, d), ["o_orderkey"]).table


@query("apply_plan", _CLEANED_SQL)
def _(spark, d):
    return pipeline.apply_plan(fx.messy_orders(spark, d), _saved_plan(spark, d), order_by=["o_orderkey"])


@query("apply_plan_frozen", _CLEANED_SQL)
def _(spark, d):
    messy, plan = fx.messy_orders(spark, d), _messy_plan(spark, d)
    frozen = pipeline.freeze(plan, pipeline.clean_table(messy, plan, ["o_orderkey"]))
    return pipeline.apply_plan(messy, frozen, order_by=["o_orderkey"], frozen=True)


def _split_messy(spark, d) -> dict[str, DataFrame]:
    messy = fx.messy_orders(spark, d)
    return {f"part_{i}": messy.filter(F.col("o_orderkey") % 3 == i) for i in range(3)}


@query(
    "clean_many",
    f"""WITH raw AS (SELECT *, concat('part_', o_orderkey % 3) AS source_file FROM ({fx.MESSY_ORDERS_SQL})),
typed AS (SELECT order_id, status, {sql.currency('price')} AS price, {sql.number('amount')} AS amount,
  {sql.date('order_date')} AS order_date, priority, source_file FROM raw),
med AS (SELECT source_file, quantile_cont(amount, 0.5) AS med FROM typed GROUP BY source_file),
mode AS (SELECT source_file, status AS top, row_number() OVER (PARTITION BY source_file
  ORDER BY count(*) DESC, status) AS rn FROM typed WHERE status <> '' GROUP BY source_file, status)
SELECT order_id, CASE WHEN status = '' THEN top ELSE status END AS status, price,
  coalesce(amount, med) AS amount, order_date, priority, source_file
FROM typed JOIN med USING (source_file) JOIN mode USING (source_file)
WHERE rn = 1 AND NOT {sql.nil_text('priority')}""",
)
def _(spark, d):
    done, _, _ = pipeline.clean_many(_split_messy(spark, d), _messy_plan(spark, d), ["o_orderkey"])
    return done


def _report(spark, d) -> dict[str, DataFrame]:
    return report.analysis_report(
        fx.stacked_documents(spark, d), ["n_chars", "nowhere"], "source", order_by=["doc_id"]
    )


@query(
    "analysis_report_sample",
    "SELECT source_file, n_chars, source, CAST(place AS INTEGER) AS place, source_rows"
    " FROM (SELECT *, row_number() OVER (PARTITION BY"
    " source_file ORDER BY doc_id) AS place, count(*) OVER (PARTITION BY source_file) AS source_rows"
    f" FROM ({fx.STACKED_DOCUMENTS_SQL})) WHERE place <= 10",
)
def _(spark, d):
    return _report(spark, d)["sample"]


@query(
    "analysis_report_describe",
    sql.with_(
        "t", fx.STACKED_DOCUMENTS_SQL, _DESCRIBE_SQL.format(sql.quartiles("t", ["n_chars"], "source_file"))
    ),
)
def _(spark, d):
    return _report(spark, d)["describe"]


@query(
    "analysis_report_stats",
    "SELECT source_file, round_even(avg(n_chars), 2) AS n_chars, count(*) AS records"
    f" FROM ({fx.STACKED_DOCUMENTS_SQL}) GROUP BY source_file",
)
def _(spark, d):
    return _report(spark, d)["entity_stats"]


@query("analysis_report_breakdown", _top_pairs_sql(fx.STACKED_DOCUMENTS_SQL, "source_file", "source", 15))
def _(spark, d):
    return _report(spark, d)["breakdown_long"]


@query("analysis_report_total", "SELECT count(*) AS total_records FROM documents")
def _(spark, d):
    return _report(spark, d)["total_records"]


@query(
    "run_summary",
    f"SELECT source_file, count(*) AS records FROM ({fx.STACKED_DOCUMENTS_SQL}) GROUP BY source_file",
)
def _(spark, d):
    log = logs.ProcessingLog([(1, "Loaded documents")]).to_df(spark)
    return report.run_summary(fx.stacked_documents(spark, d), log)["records"]


# --------------------------------------------------------------------------- null and NaN groups

_KEY = fx.KEY_TEXT


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("grp", F.expr(_KEY))


@query(
    "repair_nils_null_groups",
    f"""WITH t AS (SELECT * REPLACE ({_KEY} AS grp) FROM ({fx.KEYED_LINES_SQL})),
m AS (SELECT grp, quantile_cont(l_quantity, 0.5) AS med FROM t GROUP BY grp),
f AS (SELECT grp, l_returnflag AS flag, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, l_returnflag) AS rn
  FROM t WHERE l_returnflag IS NOT NULL GROUP BY grp, l_returnflag)
SELECT l_orderkey, l_linenumber, grp, coalesce(l_quantity, med) AS l_quantity,
  coalesce(l_returnflag, flag) AS l_returnflag FROM t JOIN m USING (grp) JOIN f USING (grp) WHERE rn = 1""",
)
def _(spark, d):
    t = fx.keyed_lines(spark, d)
    fit = nils.fit_nils(t, {"l_quantity": "fill_median", "l_returnflag": "fill_most_common"}, ["grp"])
    return _named(nils.repair_nils(t, fit)).select("l_orderkey", "l_linenumber", "grp", "l_quantity", "l_returnflag")


@query(
    "column_statistics_null_groups",
    f"WITH t AS (SELECT * REPLACE ({_KEY} AS grp) FROM ({fx.KEYED_LINES_SQL})) "
    + _statistics_sql("t", {"l_quantity": "double", "l_returnflag": "string"}, ["l_quantity"], "grp"),
)
def _(spark, d):
    t = fx.keyed_lines(spark, d).select("grp", "l_quantity", "l_returnflag")
    out = _named(statistics.column_statistics(t, by=["grp"]).drop("column_index"))
    return rounded(out, ["median", "mean", "std"])


@query(
    "infer_types_null_groups",
    f"SELECT {_KEY} AS grp, CASE WHEN grp IS NULL THEN 'datetime' WHEN isnan(grp) THEN 'integer' ELSE 'text' END"
    f" AS inferred_type, count(DISTINCT v) AS unique_count FROM (SELECT grp, CASE WHEN grp IS NULL THEN"
    f" concat('2024-01-', lpad(CAST(l_orderkey % 28 + 1 AS VARCHAR), 2, '0')) WHEN isnan(grp) THEN"
    f" CAST(l_orderkey AS VARCHAR) ELSE concat('word ', CAST(l_orderkey AS VARCHAR)) END AS v"
    f" FROM ({fx.KEYED_LINES_SQL})) GROUP BY grp",
)
def _(spark, d):
    t = fx.keyed_lines(spark, d).selectExpr(
        "grp",
        "case when grp is null then concat('2024-01-', lpad(cast(l_orderkey % 28 + 1 as string), 2, '0'))"
        " when isnan(grp) then cast(l_orderkey as string) else concat('word ', l_orderkey) end as v",
    )
    return _named(infer.infer_types(t, by=["grp"])).select("grp", "inferred_type", "unique_count")


@query(
    "describe_by_source_null",
    f"WITH t AS (SELECT {_KEY} AS source_file, l_quantity, l_extendedprice FROM ({fx.KEYED_LINES_SQL})) "
    + _DESCRIBE_SQL.format(sql.quartiles("t", ["l_quantity", "l_extendedprice"], "source_file")),
)
def _(spark, d):
    t = fx.keyed_lines(spark, d).select("grp", "l_quantity", "l_extendedprice")
    return _named(summaries.describe_by_source(t, "grp")).withColumnRenamed("grp", "source_file")


@query(
    "head_per_source_null",
    f"SELECT l_orderkey, l_linenumber, grp, CAST(place AS INTEGER) AS place, source_rows FROM (SELECT *, row_number()"
    " OVER (PARTITION BY grp ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS place, count(*) OVER (PARTITION BY grp)"
    f" AS source_rows FROM (SELECT * REPLACE ({_KEY} AS grp) FROM ({fx.KEYED_LINES_SQL}))) WHERE place <= 10",
)
def _(spark, d):
    order = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    out = selection.head_per_source(fx.keyed_lines(spark, d), order, source="grp")
    return _named(out).select("l_orderkey", "l_linenumber", "grp", "place", "source_rows")


# --------------------------------------------------------------------------- dates, layouts, second tables


@query("cast_datetime_forms", fx.DATE_MOMENTS_SQL)
def _(spark, d):
    return casts.apply_casts(fx.date_forms(spark, d), {"stamp": "datetime"})


@query(
    "infer_datetime_forms",
    f"SELECT 'stamp' AS column_name, 'datetime' AS inferred_type, round_even(count(t.stamp) / count(*), 6) AS confidence"
    f" FROM (SELECT * FROM ({fx.DATE_MOMENTS_SQL}) ORDER BY o_orderkey LIMIT 50) t",
)
def _(spark, d):
    found = infer.infer_types(fx.date_forms(spark, d), order_by=["o_orderkey"])
    return found.select("column_name", "inferred_type", F.bround("confidence", 6).alias("confidence"))


@query("read_csv_layouts", fx.FILE_LAYOUTS_SQL)
def _(spark, d):
    paths = fx.layout_files(spark, d, scratch_path(spark, "layouts"), "csv")
    rows = tables.read_sources(spark, paths, fmt="csv")
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")


@query("read_snapshot_layouts", fx.FILE_LAYOUTS_SQL)
def _(spark, d):
    paths = fx.layout_files(spark, d, scratch_path(spark, "layouts"), "parquet")
    rows = tables.read_snapshot_as_text(spark, paths)
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")


@query(
    "apply_plan_frozen_second_table",
    f"""WITH a AS ({fx.FIRST_LINES_SQL}), b AS ({fx.SECOND_LINES_SQL})
SELECT l_orderkey, l_linenumber, l_suppkey,
  coalesce(CAST(CASE WHEN n <> '12.7' THEN TRY_CAST(n AS BIGINT) END AS DOUBLE),
    (SELECT quantile_cont(CAST(n AS BIGINT), 0.5) FROM a WHERE n <> '')) AS n,
  coalesce(CAST(TRY_CAST(m AS BIGINT) AS DOUBLE), (SELECT quantile_cont(CAST(m AS BIGINT), 0.5) FROM a)) AS m,
  CASE WHEN d = '' THEN '0' ELSE concat(d, ' 00:00:00') END AS d,
  CASE WHEN f = '' THEN (SELECT f FROM a GROUP BY f ORDER BY count(*) DESC, f LIMIT 1) ELSE f END AS f
FROM b""",
)
def _(spark, d):
    plan = CleaningPlan(
        {c: ColumnDecision(t) for c, t in (("n", "integer"), ("m", "integer"), ("d", "datetime"), ("f", "categorical"))},
        False,
        {"n": "fill_median", "m": "fill_median", "d": "fill_zero", "f": "fill_most_common"},
    )
    frozen = pipeline.freeze(plan, pipeline.clean_table(fx.first_lines(spark, d), plan))
    out = pipeline.apply_plan(fx.second_lines(spark, d), frozen, frozen=True)
    return out.withColumns({c: F.col(c).cast("double") for c in ("n", "m")})


_UNPLANNED_OUT = " UNION ALL ".join(
    f"SELECT CAST(k AS BIGINT) AS k, {u} AS u, 'part_{i}' AS source_file FROM ({text})"
    for i, (u, text) in enumerate(
        zip(("CAST(CAST(CAST(trim(u) AS DOUBLE) AS BIGINT) AS VARCHAR)", "u", "u"), fx.UNPLANNED_SQL)
    )
)
_KEY_PLAN = CleaningPlan({"k": ColumnDecision("integer")}, True)


@query("clean_many_unplanned", _UNPLANNED_OUT)
def _(spark, d):
    done, _, _ = pipeline.clean_many(fx.unplanned_files(spark, d), _KEY_PLAN)
    return done


@query("clean_many_unplanned_layouts", _UNPLANNED_OUT)
def _(spark, d):
    files = fx.unplanned_files(spark, d)
    files["part_1"] = files["part_1"].withColumn("more", F.lit("x"))
    done, _, _ = pipeline.clean_many(files, _KEY_PLAN)
    return done.drop("more")


@query(
    "crosstab_stored_levels",
    "SELECT concat('urgent', is_urgent) AS source_file, "
    + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in "FOP")
    + f" FROM ({fx.MESSY_ORDERS_SQL}) WHERE o_orderkey % 2 = 1 GROUP BY 1",
)
def _(spark, d):
    messy = fx.messy_orders(spark, d)
    levels = _messy_plan(spark, d).levels["status"]
    later = messy.filter("o_orderkey % 2 = 1").selectExpr("concat('urgent', is_urgent) as source_file", "status")
    return summaries.crosstab_counts(later, "status", levels=levels)


# --------------------------------------------------------------------------- flagship


@query(
    "clean_and_summarize",
    f"WITH cleaned AS ({_CLEANED_SQL}) SELECT concat('orders_', status) AS source_file, count(*) AS row_count,"
    " round_even(avg(price), 2) AS avg_price, round_even(avg(amount), 2) AS avg_amount FROM cleaned GROUP BY status",
)
def clean_and_summarize(spark, d):
    """Infer, clean and summarize messy orders."""
    messy = fx.messy_orders(spark, d)
    cleaned = pipeline.clean_table(messy, _messy_plan(spark, d), ["o_orderkey"]).table
    by_status = cleaned.withColumn("source_file", F.concat(F.lit("orders_"), "status"))
    return summaries.source_summary(by_status)
