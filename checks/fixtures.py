"""Messy tables derived from the clean test tables, in Spark and in SQL.

Each ``*_SQL`` text yields the same rows as the Spark function next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MESSY_ORDERS_SQL = """
SELECT o_orderkey,
  CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderstatus END AS status,
  concat('$', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)) AS price,
  CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' WHEN o_orderkey % 19 = 0 THEN ''
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN ' T' ELSE 'f' END AS is_urgent,
  CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
  CASE WHEN o_orderkey % 7 = 0 THEN ' ' WHEN o_orderkey % 13 = 0 THEN 'NaN'
       ELSE o_orderpriority END AS priority
FROM orders"""


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text orders with blanks, bad numbers, mixed dates; ``o_orderkey`` gives the row order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(o_orderkey as string) as order_id",
        "case when o_orderkey % 11 = 0 then '' else o_orderstatus end as status",
        "concat('$', cast(cast(o_totalprice as decimal(18,2)) as string)) as price",
        "case when o_orderkey % 17 = 0 then 'n/a' when o_orderkey % 19 = 0 then ''"
        " else cast(cast(o_totalprice as decimal(18,2)) as string) end as amount",
        "case when o_orderpriority in ('1-URGENT','2-HIGH') then ' T' else 'f' end as is_urgent",
        "case when o_orderkey % 5 = 0 then date_format(o_orderdate,'MM/dd/yyyy')"
        " else cast(cast(o_orderdate as date) as string) end as order_date",
        "case when o_orderkey % 7 = 0 then ' ' when o_orderkey % 13 = 0 then 'NaN'"
        " else o_orderpriority end as priority",
    )


MESSY_COLUMNS = ["order_id", "status", "price", "amount", "is_urgent", "order_date", "priority"]

DUP_ORDERS_SQL = "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 20 = 0"


def dup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with every twentieth row repeated."""
    orders = table(spark, sf_dir, "orders")
    return orders.unionAll(orders.filter("o_orderkey % 20 = 0"))


SPARSE_LINEITEM_SQL = """
SELECT l_orderkey,
  CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
  l_linenumber,
  CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  l_extendedprice,
  CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_shipdate
FROM lineitem"""


def sparse_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with typed nulls."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "case when l_partkey % 8 = 0 then null else l_partkey end as l_partkey",
        "l_linenumber",
        "case when (l_orderkey + l_linenumber) % 9 = 0 then null else l_quantity end as l_quantity",
        "l_extendedprice",
        "case when (l_orderkey + l_linenumber) % 10 = 0 then null else l_returnflag end as l_returnflag",
        "l_shipdate",
    )


def order_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three tables by status: the second has text customer keys, the third lacks the priority."""
    orders = table(spark, sf_dir, "orders")
    f, o, p = (orders.filter(F.col("o_orderstatus") == s) for s in "FOP")
    return {
        "orders_F": f,
        "orders_O": o.withColumn("o_custkey", F.col("o_custkey").cast("string")),
        "orders_P": p.drop("o_orderpriority"),
    }


ORDER_SOURCES_SQL = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  'orders_' || o_orderstatus AS source_file
FROM orders WHERE o_orderstatus IN ('F','O','P')"""

STACKED_DOCUMENTS_SQL = """
SELECT doc_id, lang, n_chars, source, concat('docs_', lang) AS source_file FROM documents"""


def stacked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stacked by language."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang", "n_chars", "source", "concat('docs_', lang) as source_file"
    )


STACKED_LINEITEM_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
  concat('flag_', l_returnflag) AS source_file FROM lineitem"""


def stacked_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items stacked by return flag."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_linestatus", "concat('flag_', l_returnflag) as source_file",
    )


RULE_COLUMNS_SQL = """
SELECT o_orderkey,
  '' AS empty_column,
  CAST(o_orderkey AS VARCHAR) AS order_id,
  CAST(o_orderkey AS VARCHAR) AS order_number,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' WHEN o_orderkey % 3 = 0 THEN '' ELSE ' no ' END AS answer,
  CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'f' END AS mixed_answer,
  CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS nine_tenths,
  CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS above_nine_tenths,
  CASE WHEN o_orderkey % 13 = 0 THEN 'inf' WHEN o_orderkey % 17 = 0 THEN concat(' ', o_custkey, '.0 ')
       ELSE CAST(o_custkey AS VARCHAR) END AS whole_number,
  CASE WHEN o_orderkey % 13 = 0 THEN '.5' WHEN o_orderkey % 17 = 0 THEN '5e-1'
       ELSE CAST(o_custkey AS VARCHAR) END AS decimal_number,
  CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y/%m/%d')
       WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%d/%m/%Y')
       WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%m/%d/%Y')
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS any_date,
  CASE WHEN o_orderkey % 5 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS four_fifths_date,
  concat('c', o_custkey % 20) AS twenty_values,
  concat('c', o_custkey % 21) AS twenty_one_values,
  concat('order of customer ', o_custkey, ' placed with priority ', o_orderpriority,
         ' and a remark that is long enough to travel as a digest') AS remark
FROM orders"""


def rule_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text column per inference rule, several just at a threshold."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "'' as empty_column",
        "cast(o_orderkey as string) as order_id",
        "cast(o_orderkey as string) as order_number",
        "case when o_orderkey % 2 = 0 then 'Yes' when o_orderkey % 3 = 0 then '' else ' no ' end as answer",
        "case when o_orderkey % 2 = 0 then 'yes' else 'f' end as mixed_answer",
        "case when o_orderkey % 10 = 0 then 'x' else cast(o_custkey as string) end as nine_tenths",
        "case when o_orderkey % 11 = 0 then 'x' else cast(o_custkey as string) end as above_nine_tenths",
        "case when o_orderkey % 13 = 0 then 'inf' when o_orderkey % 17 = 0 then concat(' ', o_custkey, '.0 ')"
        " else cast(o_custkey as string) end as whole_number",
        "case when o_orderkey % 13 = 0 then '.5' when o_orderkey % 17 = 0 then '5e-1'"
        " else cast(o_custkey as string) end as decimal_number",
        "case when o_orderkey % 4 = 0 then date_format(o_orderdate, 'yyyy/MM/dd')"
        " when o_orderkey % 4 = 1 then date_format(o_orderdate, 'dd/MM/yyyy')"
        " when o_orderkey % 4 = 2 then date_format(o_orderdate, 'MM/dd/yyyy')"
        " else cast(cast(o_orderdate as date) as string) end as any_date",
        "case when o_orderkey % 5 = 0 then 'soon' else cast(cast(o_orderdate as date) as string) end"
        " as four_fifths_date",
        "concat('c', o_custkey % 20) as twenty_values",
        "concat('c', o_custkey % 21) as twenty_one_values",
        "concat('order of customer ', o_custkey, ' placed with priority ', o_orderpriority,"
        " ' and a remark that is long enough to travel as a digest') as remark",
    )


CAST_COLUMNS_SQL = """
SELECT o_orderkey,
  CASE o_orderkey % 7 WHEN 0 THEN concat(' ', o_custkey, ' ') WHEN 1 THEN concat('-', o_custkey)
    WHEN 2 THEN concat(o_custkey, '.0') WHEN 3 THEN concat(o_custkey, 'e1') WHEN 4 THEN 'n/a'
    WHEN 5 THEN '' ELSE concat('900719925474', o_custkey + 10000) END AS whole,
  CASE o_orderkey % 6 WHEN 0 THEN concat(o_custkey, '.5') WHEN 1 THEN '1_000' WHEN 2 THEN 'inf'
    WHEN 3 THEN concat('.', o_custkey) WHEN 4 THEN '1e400' ELSE CAST(o_custkey AS VARCHAR) END AS part,
  CASE o_orderkey % 8 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' no' WHEN 2 THEN '1' WHEN 3 THEN 'F'
    WHEN 4 THEN 'maybe' WHEN 5 THEN '' WHEN 6 THEN 'Y ' ELSE '0' END AS flag,
  CASE o_orderkey % 8 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 4 THEN strftime(o_orderdate, '%Y%m%d') WHEN 5 THEN strftime(o_orderdate, '%d %B %Y')
    WHEN 6 THEN '2024-02-30' ELSE 'now' END AS stamp,
  CASE o_orderkey % 5 WHEN 0 THEN concat('$1,', 100 + o_custkey % 900, '.50') WHEN 1 THEN concat('€', o_custkey)
    WHEN 2 THEN concat(o_custkey, ' USD') WHEN 3 THEN concat('(', o_custkey, ')')
    ELSE concat('¥', o_custkey, '.25') END AS money,
  lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS code
FROM orders"""


def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns with every spelling the casts have to deal with."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case o_orderkey % 7 when 0 then concat(' ', o_custkey, ' ') when 1 then concat('-', o_custkey)"
        " when 2 then concat(o_custkey, '.0') when 3 then concat(o_custkey, 'e1') when 4 then 'n/a'"
        " when 5 then '' else concat('900719925474', o_custkey + 10000) end as whole",
        "case o_orderkey % 6 when 0 then concat(o_custkey, '.5') when 1 then '1_000' when 2 then 'inf'"
        " when 3 then concat('.', o_custkey) when 4 then '1e400' else cast(o_custkey as string) end as part",
        "case o_orderkey % 8 when 0 then 'TRUE' when 1 then ' no' when 2 then '1' when 3 then 'F'"
        " when 4 then 'maybe' when 5 then '' when 6 then 'Y ' else '0' end as flag",
        "case o_orderkey % 8 when 0 then date_format(o_orderdate, 'yyyy-MM-dd')"
        " when 1 then date_format(o_orderdate, 'yyyy/MM/dd') when 2 then date_format(o_orderdate, 'MM/dd/yyyy')"
        " when 3 then date_format(o_orderdate, 'dd/MM/yyyy') when 4 then date_format(o_orderdate, 'yyyyMMdd')"
        " when 5 then date_format(o_orderdate, 'dd MMMM yyyy') when 6 then '2024-02-30' else 'now' end as stamp",
        "case o_orderkey % 5 when 0 then concat('$1,', 100 + o_custkey % 900, '.50')"
        " when 1 then concat('€', o_custkey) when 2 then concat(o_custkey, ' USD')"
        " when 3 then concat('(', o_custkey, ')') else concat('¥', o_custkey, '.25') end as money",
        "lpad(cast(o_custkey as string), 8, '0') as code",
    )


FILE_ROWS_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN concat('/lake/', o_orderstatus, '/listings.csv')
  ELSE concat('/lake/all/orders_', o_orderstatus, '.v1.csv') END AS file_path FROM orders"""


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the path of a file each row might have come from; some stems repeat."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 3 = 0 then concat('/lake/', o_orderstatus, '/listings.csv')"
        " else concat('/lake/all/orders_', o_orderstatus, '.v1.csv') end as file_path",
    )


REPLIES_SQL = """
SELECT event_id, CASE event_id % 5
    WHEN 0 THEN concat('Here it is:', chr(10), '```json', chr(10), props, chr(10), '```', chr(10), 'Done.')
    WHEN 1 THEN props
    WHEN 2 THEN concat('nothing ', event_type)
    WHEN 3 THEN concat('first ```not json``` then ```', chr(10), '[', props, ', 1]', chr(10), '```')
    ELSE concat('```', event_type, '```') END AS reply
FROM events"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with JSON in fences, without fences, or none at all."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_id % 5"
        " when 0 then concat('Here it is:', chr(10), '```json', chr(10), props, chr(10), '```', chr(10), 'Done.')"
        " when 1 then props"
        " when 2 then concat('nothing ', event_type)"
        " when 3 then concat('first ```not json``` then ```', chr(10), '[', props, ', 1]', chr(10), '```')"
        " else concat('```', event_type, '```') end as reply",
    )


KEYED_LINES_SQL = """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_returnflag,
  CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST(l_linenumber AS DOUBLE) END AS grp
FROM (""" + SPARSE_LINEITEM_SQL + ")"

# a key as text: rows with NaN in them cannot be compared
KEY_TEXT = "CASE WHEN grp IS NULL THEN 'none' WHEN isnan(grp) THEN 'odd' ELSE concat('k', CAST(grp AS INT)) END"


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with missing values, grouped by a key that is null in some rows and NaN in others."""
    return sparse_lineitem(spark, sf_dir).selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag",
        "case when l_linenumber = 1 then null when l_linenumber = 2 then double('NaN')"
        " else cast(l_linenumber as double) end as grp",
    )


# How a day of an order is written, by the order's number: the text in Spark, in DuckDB, and the clock
# the text holds.
DATE_FORMS = [
    ("date_format(d, 'MM/dd/yy')", "strftime(d, '%m/%d/%y')", ""),
    ("date_format(d, 'd-MMM-yy')", "strftime(d, '%-d-%b-%y')", ""),
    ("date_format(d, \"MMM d yyyy '10:30'\")", "strftime(d, '%b %-d %Y 10:30')", "10:30:00"),
    ("date_format(d, \"MMM d, yyyy '10:30 PM'\")", "strftime(d, '%b %-d, %Y 10:30 PM')", "22:30:00"),
    ("date_format(d, \"yyyy-MM-dd '10:30 PM'\")", "strftime(d, '%Y-%m-%d 10:30 PM')", "22:30:00"),
    ("date_format(d, \"d MMM yyyy '08:00'\")", "strftime(d, '%-d %b %Y 08:00')", "08:00:00"),
    ("date_format(d, 'EEEE, MMMM d, yyyy')", "strftime(d, '%A, %B %-d, %Y')", ""),
    ("date_format(d, \"EEE, dd MMM yyyy '00:00:00 GMT'\")", "strftime(d, '%a, %d %b %Y 00:00:00 GMT')", ""),
    ("date_format(d, \"yyyy-MM-dd'T10:30:00+0000'\")", "strftime(d, '%Y-%m-%dT10:30:00+0000')", "10:30:00"),
    ("date_format(d, \"yyyy-MM-dd'T10:30:00+05'\")", "strftime(d, '%Y-%m-%dT10:30:00+05')", "05:30:00"),
    ("date_format(d, \"yyyy-MM-dd '10:30:00 UTC'\")", "strftime(d, '%Y-%m-%d 10:30:00 UTC')", "10:30:00"),
    ("date_format(d, \"yyyy-MM-dd'T10'\")", "strftime(d, '%Y-%m-%dT10')", "10:00:00"),
    ("date_format(d, \"yyyy-MM-dd '10:30:00.123456789'\")", "strftime(d, '%Y-%m-%d 10:30:00.123456789')", "10:30:00.123456"),
    ("date_format(d, \"yyyyMMdd'T103000'\")", "strftime(d, '%Y%m%dT103000')", "10:30:00"),
    ("date_format(d, \"yyyyMMdd'103000'\")", "strftime(d, '%Y%m%d103000')", "10:30:00"),
    ("date_format(d, 'yyyy MMM d')", "strftime(d, '%Y %b %-d')", ""),
    ("date_format(d, \"d'th' MMMM yyyy\")", "strftime(d, '%-dth %B %Y')", ""),
    ("concat(date_format(d, 'yyyy-MM-dd'), repeat(' ', 60))", "concat(strftime(d, '%Y-%m-%d'), repeat(' ', 60))", ""),
    ("concat(repeat(' ', 3), date_format(d, \"EEEE,'\t'MMMM d\"), repeat(' ', 80), year(d))", "concat('   ', strftime(d, '%A,\t%B %-d'), repeat(' ', 80), year(d))", ""),
    ("date_format(d, \"'12:30' yyyy-MM-dd\")", "strftime(d, '12:30 %Y-%m-%d')", "12:30:00"),
    ("date_format(d, \"'10:30' MMM d, yyyy\")", "strftime(d, '10:30 %b %-d, %Y')", "10:30:00"),
    ("date_format(d, \"'10:30PM' M/d/yyyy\")", "strftime(d, '10:30PM %-m/%-d/%Y')", "22:30:00"),
    ("date_format(d, \"EEE MMM  d '10:30:00' yyyy\")", "strftime(d, '%a %b  %-d 10:30:00 %Y')", "10:30:00"),
    ("date_format(d, \"yyyy-M-d '1:2'\")", "strftime(d, '%Y-%-m-%-d 1:2')", "01:02:00"),
    ("date_format(d, \"yyyyMMdd '1030'\")", "strftime(d, '%Y%m%d 1030')", "10:30:00"),
    ("date_format(d, \"yyyy-MM-dd '10h30'\")", "strftime(d, '%Y-%m-%d 10h30')", "10:30:00"),
    ("date_format(d, 'MMM-dd-yyyy')", "strftime(d, '%b-%d-%Y')", ""),
    ("date_format(d, \"d'th of' MMMM yyyy\")", "strftime(d, '%-dth of %B %Y')", ""),
    ("date_format(d, \"yyyy-MM-dd '10:30:00 EST'\")", "strftime(d, '%Y-%m-%d 10:30:00 EST')", "10:30:00"),
    ("date_format(d, \"yyyy-MM-dd'-10:30'\")", "strftime(d, '%Y-%m-%d-10:30')", "10:30:00"),
    # a decimal comma, whose fraction is lost: the month is what follows
    ("date_format(d, \"yyyy,'17',MM\")", "strftime(d, '%Y,17,%m')", "month"),
    ("concat(year(d), 'Q', quarter(d))", "concat(year(d), 'Q', quarter(d))", "quarter"),
    ("'2024-02-30'", "'2024-02-30'", None),
    ("'13/13/2024'", "'13/13/2024'", None),
    ("'half past ten'", "'half past ten'", None),
]


def _by_form(parts: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(parts))
    return f"CASE o_orderkey % {len(parts)} {cases} END"


def _moment(clock: str | None) -> str:
    if clock is None:
        return "CAST(NULL AS TIMESTAMP)"
    if clock == "month":
        return "CAST(date_trunc('month', d) AS TIMESTAMP)"
    if clock == "quarter":
        return "CAST(date_trunc('quarter', d) AS TIMESTAMP)"
    return f"CAST(strftime(d, '%Y-%m-%d {clock or '00:00:00'}') AS TIMESTAMP)"


_DAYS_SQL = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"
DATE_FORMS_SQL = f"SELECT o_orderkey, {_by_form([f[1] for f in DATE_FORMS])} AS stamp FROM {_DAYS_SQL}"
DATE_MOMENTS_SQL = f"SELECT o_orderkey, {_by_form([_moment(f[2]) for f in DATE_FORMS])} AS stamp FROM {_DAYS_SQL}"


def date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days as text in many forms, some of them no dates."""
    days = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_orderdate as timestamp) as d")
    return days.selectExpr("o_orderkey", f"{_by_form([f[0] for f in DATE_FORMS])} as stamp")


# Three files of orders: the second in another order of columns and with one more, the third with one less.
FILE_LAYOUTS = {
    "F": ["o_orderkey", "o_totalprice", "o_orderstatus"],
    "O": ["o_totalprice", "o_orderpriority", "o_orderstatus", "o_orderkey"],
    "P": ["o_orderstatus", "o_orderkey"],
}
FILE_LAYOUTS_SQL = " UNION ALL ".join(
    "SELECT " + ", ".join(
        f"CAST({c if c in columns else 'NULL'} AS VARCHAR) AS {c}"
        for c in ("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    ) + f" FROM orders WHERE o_orderstatus = '{s}'"
    for s, columns in FILE_LAYOUTS.items()
)


def layout_files(spark: SparkSession, sf_dir: str, folder: str, fmt: str) -> list[str]:
    orders = table(spark, sf_dir, "orders")
    paths = []
    for status, columns in FILE_LAYOUTS.items():
        path = f"{folder}/orders_{status}.{fmt}"
        rows = orders.filter(F.col("o_orderstatus") == status).select(columns)
        if fmt == "csv":
            rows.write.options(header=True, quoteAll=True, escape='"').csv(path)
        else:
            rows.write.parquet(path)
        paths.append(path)
    return paths


# Two tables for one plan. The second has fractions among the integers, and nils where the first has none.
FIRST_LINES_SQL = """
SELECT CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS n,
  CAST(l_linenumber AS VARCHAR) AS m,
  CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS d, l_returnflag AS f
FROM lineitem WHERE l_orderkey % 2 = 0"""
SECOND_LINES_SQL = """
SELECT l_orderkey, l_linenumber, l_suppkey,
  CASE WHEN l_orderkey % 7 = 0 THEN '12.7' WHEN l_orderkey % 9 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS n,
  CASE WHEN l_orderkey % 9 = 0 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS m,
  CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS d,
  CASE WHEN l_orderkey % 9 = 0 THEN '' ELSE l_returnflag END AS f
FROM lineitem WHERE l_orderkey % 2 = 1"""


def _spark_sql(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    body = text.replace(f"FROM {name}", "FROM {t}").replace("VARCHAR", "STRING")
    return spark.sql(body, t=table(spark, sf_dir, name))


def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, "lineitem", FIRST_LINES_SQL)


def second_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, "lineitem", SECOND_LINES_SQL)


# Files whose column ``u`` a plan does not know: integers in one, words in the next, fractions in the last.
UNPLANNED_SQL = [
    "SELECT CAST(o_orderkey AS VARCHAR) AS k, concat(' ', CAST(o_orderkey % 50 AS VARCHAR), '.0') AS u FROM orders"
    " WHERE o_orderkey % 3 = 0",
    "SELECT CAST(o_orderkey AS VARCHAR) AS k, concat('abc', CAST(o_orderkey % 50 AS VARCHAR)) AS u FROM orders"
    " WHERE o_orderkey % 3 = 1",
    "SELECT CAST(o_orderkey AS VARCHAR) AS k, concat(CAST(o_orderkey % 50 AS VARCHAR), '.5') AS u FROM orders"
    " WHERE o_orderkey % 3 = 2",
]


def unplanned_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {f"part_{i}": _spark_sql(spark, sf_dir, "orders", text) for i, text in enumerate(UNPLANNED_SQL)}
