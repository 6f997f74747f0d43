"""CSV files whose fields may hold line breaks, read by many tasks.

A line ends within a quoted field or between rows, depending on its quotes and on how it starts. Both
cases are tried on each line by itself; the two outcomes tell what a line does to the state: nothing, turn
it over, or fix it. Within a block of a file the lines are composed in order, then the blocks of a file,
which gives the true state at every line. A row on one line is taken as it is, lines that share a row are
brought together. So a file is cut like any other text, and no task needs more than its block and the row
it is at.

Quotes count at the start of a field only, two within a quoted field are one, and what follows the closing
quote belongs to the field. Lines that are empty or all spaces and tabs are no rows, missing values at the end of a row are ``''``. Rows
that have more values than the header, that are no UTF-8 (or not of the encoding given), and a field that is still
open at the end of its file are rejected: they are kept apart with file, line and reason.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import broadcast_if_small, ref
from .workspace import discard, materialize

_QUOTED = r'(?:[^"]++|"")*+"[^,]*+'
_FIELD = rf'(?:"{_QUOTED}|(?!")[^,]*+)'
_WHOLE = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+\z"
_EMPTY = r"\A[ \t]*\z"
_GOES_ON = rf"(?s)\A{_QUOTED}(?:,{_FIELD})*+\z"
REASONS = WIDE, NOT_TEXT, OPEN = "more values than the header", "bytes that are no text", "open quote at the end of the file"
REJECTED = "file_path string, line bigint, reason string, record string"


@dataclass(frozen=True)
class Layout:
    """What the first look tells of a file: its columns, and whether every line is a row of them."""

    file: str
    columns: tuple[str, ...]
    header_line: int
    plain: bool


def column_names(header: Sequence[str]) -> tuple[str, ...]:
    """Names as they stand; one that is repeated gets a number, one that is missing its place."""
    given = [name or f"Unnamed: {i}" for i, name in enumerate(header)]
    taken, times, out = set(given), {}, []
    for name in given:
        n, new = times.get(name, 0), name
        while n and (new := f"{name}.{n}") in taken:
            n += 1
        times[name] = n + 1
        taken.add(new)
        out.append(new)
    return tuple(out)


def _lines(spark: SparkSession, files: Sequence[str], encoding: str | None) -> DataFrame:
    """Lines with their place: file, block (first byte of the part of the file), i (order within it)."""
    given = spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"),
        "value",
    )
    if encoding is None:
        return given.withColumn("text", F.is_valid_utf8("value"))
    return given.withColumn("value", F.decode(F.col("value").cast("binary"), encoding)).withColumn("text", F.lit(True))


def _quoted(c: str) -> Column:
    return F.contains(F.col(c), F.lit('"'))


def _whole(c: str) -> Column:
    """Whether a line that starts between rows also ends there."""
    return F.when(_quoted(c), F.col(c).rlike(_WHOLE)).otherwise(True)


def _values(c: str) -> Column:
    """The values of a row."""
    found = F.regexp_extract_all(F.concat(F.lit(","), F.col(c)), F.lit(f"(?s),({_FIELD})"), F.lit(1))

    def bare(field: Column) -> Column:
        inner = F.regexp_extract(field, r'(?s)\A"((?:[^"]++|"")*+)"', 1)
        rest = F.substring(field, F.length(inner) + 3, F.length(field))
        return F.when(field.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).otherwise(field)

    return F.when(_quoted(c), F.transform(found, bare)).otherwise(F.split(c, ",", -1))


def _ended(c: str) -> Column:
    """A line without the carriage return of its end."""
    return F.regexp_replace(c, r"\r\z", "")


def layouts(spark: SparkSession, paths: Sequence[str], encoding: str | None = None, breaks: bool | None = None) -> list[Layout]:
    """One look at all lines of all files, in one job: columns, and whether lines are rows. ``breaks`` says that
    fields hold line breaks (or that none does)."""
    lines = _lines(spark, paths, encoding).withColumn("row", _ended("value"))
    first = F.when(~F.col("row").rlike(_EMPTY), F.struct("block", "i", "row", _whole("row").alias("whole")))
    commas = F.length("row") - F.length(F.replace("row", F.lit(",")))
    width = F.when(_quoted("row"), F.size(_values("row"))).otherwise(commas + 1)
    # lines of control characters, which Spark's reader takes for empty
    blank = ~F.col("row").rlike(r"[^\x00-\x20]") & ~F.col("row").rlike(_EMPTY)
    # combined in every task: a row for each block of a file
    parts = lines.groupBy("file", "block").agg(
        F.min(first).alias("first"), F.min("i").alias("start"), F.bool_and(_whole("row")).alias("whole"),
        F.max(width).alias("width"), F.bool_and("text").alias("text"), F.bool_or(blank).alias("blank"),
    )
    each = parts.groupBy("file").agg(
        F.min_by(F.struct("first.*", "start"), "block").alias("head"),
        F.bool_and("whole").alias("whole"), F.max("width").alias("width"),
        F.bool_and("text").alias("text"), F.bool_or("blank").alias("blank"),
    )
    out = []
    for r in sorted(each.collect(), key=lambda r: r.file):
        if r.head["row"] is None:
            raise ValueError(f"no header in {path_of(spark, r.file)}")
        header = r.head["row"] if r.head["whole"] else _long_header(spark, r.file, encoding)
        names = next(csv.reader([header]))
        whole = r.whole if breaks is None else not breaks
        plain = whole and r.text and not r.blank and r.width <= len(names)
        out.append(Layout(r.file, column_names(names), r.head["i"] - r.head["start"] + 1, bool(plain)))
    if not out:
        raise ValueError(f"no header in {paths[0]}")
    return out


def _long_header(spark: SparkSession, file: str, encoding: str | None) -> str:
    """A header with line breaks in its names."""
    scratch: list[str] = []
    found = records(spark, [file], encoding, scratch).filter("NOT open").agg(F.min_by("record", "line")).first()[0]
    for path in scratch:
        discard(spark, path)
    if found is None:
        raise ValueError(f"no header in {path_of(spark, file)}")
    return found


def path_of(spark: SparkSession, uri: str) -> str:
    """The path a file's address stands for, as readers take it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def real_path(address: Column) -> Column:
    """The same as a column: characters that addresses write in hexadecimal are themselves again."""
    return F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))


# ------------------------------------------------------------------ rows


def _flipped(state: Column, times: Column) -> Column:
    return F.when(times % 2 == 1, ~state).otherwise(state)


def _states(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """For things in order that take the state between rows to ``r`` and the one within a field to ``q`` (true for
    between rows): ``fixed``, the state before each if an earlier one fixes it, and ``turns`` since then or
    since the start."""
    before = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turned = rows.withColumn("all_turns", F.coalesce(F.sum((~F.col("r") & F.col("q")).cast("int")).over(before), F.lit(0)))
    last = F.last(F.when(F.col("r") == F.col("q"), F.struct("r", "all_turns")), ignorenulls=True).over(before)
    since = turned.withColumn("last", last)
    return since.select(
        *[ref(c) for c in rows.columns], F.col("last.r").alias("fixed"),
        (F.col("all_turns") - F.coalesce(F.col("last.all_turns"), F.lit(0))).alias("turns"),
    )


def _before(start: Column) -> Column:
    """The state before a line or block, given the one before the first."""
    return _flipped(F.coalesce(F.col("fixed"), start), F.col("turns"))


def _after(state: Column) -> Column:
    return F.when(state, F.col("r")).otherwise(F.col("q"))


def _blocks(marked: DataFrame) -> DataFrame:
    """For each block the state and the number of lines before it, and the state at the end of the file."""
    last = F.max_by(F.struct("fixed", "turns", "r", "q"), "i")
    ends = marked.groupBy("file", "block").agg(last.alias("z"), F.count("*").alias("n"), F.min("i").alias("start")).select(
        "file", "block", "n", "start", *[F.col(f"z.{c}").alias(c) for c in ("fixed", "turns", "r", "q")]
    )
    through = ends.select(
        "file", "block", "n", "start", _after(_before(F.lit(True))).alias("r"), _after(_before(F.lit(False))).alias("q")
    )
    whole_file = Window.partitionBy("file").orderBy("block")
    earlier = whole_file.rowsBetween(Window.unboundedPreceding, -1)
    placed = _states(through, ["file"], "block").withColumn("start_state", _before(F.lit(True)))
    return placed.select(
        F.col("file").alias("file_"), F.col("block").alias("block_"), "start", "start_state",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
        F.last(_after(F.col("start_state"))).over(whole_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("closed"),
    )


def records(spark: SparkSession, files: Sequence[str], encoding: str | None, scratch: list[str]) -> DataFrame:
    """The rows of files as text: file, line (of the first of them), record, text (false for other bytes), open."""
    lines = _lines(spark, [path_of(spark, f) for f in files], encoding).withColumn("row", _ended("value"))
    goes_on = F.when(_quoted("row"), F.col("row").rlike(_GOES_ON)).otherwise(False)
    marked = _states(lines.withColumn("r", _whole("row")).withColumn("q", goes_on).drop("row"), ["file", "block"], "i")
    marked, path = materialize(marked, "lines")
    scratch.append(path)
    blocks, path = materialize(_blocks(marked), "blocks")
    scratch.append(path)
    same_block = (F.col("file") == F.col("file_")) & (F.col("block") == F.col("block_"))
    known = marked.join(broadcast_if_small(blocks), same_block).withColumn("between", _before(F.col("start_state")))
    known = known.select(
        "file", "block", "i", "value", "text", "between", _after(F.col("between")).alias("ends"), "closed",
        (F.col("lines_before") + F.col("i") - F.col("start") + 1).alias("line"),
    )
    alone = known.filter("between AND ends").select("file", "line", F.col("value").alias("record"), "text", F.lit(False).alias("open"))
    # lines that share a row: its number in the file is known from those that start within blocks
    shared = known.filter("NOT (between AND ends)")
    begun = F.col("between").cast("int")
    per_block = shared.groupBy(F.col("file").alias("file_"), F.col("block").alias("block_")).agg(F.sum(begun).alias("rows"))
    earlier = Window.partitionBy("file_").orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)
    base = per_block.withColumn("base", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    all_rows = Window.partitionBy("file_")
    base = base.withColumn("total", F.sum("rows").over(all_rows)).drop("rows")
    upto = Window.partitionBy("file", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    numbered = shared.withColumn("in_block", F.sum(begun).over(upto)).join(base, same_block)
    number = F.col("base") + F.col("in_block")
    numbered = numbered.withColumn("number", number).withColumn("open", ~F.col("closed") & (number == F.col("total")))
    parts = F.sort_array(F.collect_list(F.struct("block", "i", "value")))
    joined = numbered.filter("NOT open").groupBy("file", "number").agg(
        F.min("line").alias("line"), parts.alias("parts"), F.bool_and("text").alias("text")
    ).select("file", "line", F.array_join("parts.value", "\n").alias("record"), "text", F.lit(False).alias("open"))
    # a field that never ends may hold the rest of its file, of which only the first line is shown
    left = numbered.filter("open AND between").select("file", "line", F.col("value").alias("record"), "text", "open")
    return alone.unionByName(joined).unionByName(left).withColumn("record", _ended("record")).filter(~F.col("record").rlike(_EMPTY) | F.col("open"))


def read_layout(
    spark: SparkSession, group: Sequence[Layout], encoding: str | None = None, with_path: str | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows of files of one layout that are not plain: the table, the rejected rows, and the paths of what both read."""
    scratch: list[str] = []
    columns = group[0].columns
    schema = T.StructType().add("head_file", T.StringType()).add("head_line", T.LongType())
    heads = spark.createDataFrame([(g.file, g.header_line) for g in group], schema)
    rows = records(spark, [g.file for g in group], encoding, scratch)
    # as many heads as there are files
    is_head = (F.col("file") == F.col("head_file")) & (F.col("line") == F.col("head_line"))
    rows = rows.join(broadcast_if_small(heads), is_head, "left_anti").withColumn("values", _values("record"))
    reason = (
        F.when(F.col("open"), OPEN).when(~F.col("text"), NOT_TEXT).when(F.size("values") > len(columns), WIDE)
    )
    judged, path = materialize(rows.withColumn("reason", reason), "rows")
    scratch.append(path)
    named = [F.coalesce(F.get("values", F.lit(j)), F.lit("")).alias(c) for j, c in enumerate(columns)]
    path_column = [real_path(F.col("file")).alias(with_path)] if with_path else []
    good = judged.filter("reason IS NULL").select(*named, *path_column)
    bad = judged.filter("reason IS NOT NULL").select(real_path(F.col("file")).alias("file_path"), "line", "reason", "record")
    return good, bad, scratch
