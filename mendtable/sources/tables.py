"""Reading tables as text, labelling rows by file, and writing snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import broadcast_if_small, local_table, quoted, ref, unused_name
from ..functions.parsing import path_parent, path_stem
from ..operators.selection import SOURCE, stack_by_name
from . import csv_rows
from .snapshots import current_path, write_snapshot
from .workspace import materialize

# File suffixes of each readable format.
CSV_SUFFIXES = [".csv"]
SNAPSHOT_SUFFIXES = [".parquet"]


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    dot = name.rfind(".")
    return name[dot:].lower() if dot > 0 else ""


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    return [p for p in paths if path_exists(spark, p)]


def blanks_for_nulls(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[F.coalesce(ref(c), F.lit("")).alias(c) if c in text else ref(c) for c in df.columns])


def read_text_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str | None = None,
    multi_line: bool | None = None,
    with_path: str | None = None,
    stage: bool = False,
    encoding: str | None = None,
    report: bool = False,
) -> DataFrame:
    """Read files, every column as text, blanks as ``''``.

    Each file is read by its own header, names as they stand (a repeated one gets a number), and the
    files are stacked by column name; a column that a file lacks is null in its rows. The format
    follows the suffix unless given. Fields may hold line breaks, and such files too are cut and read
    by many tasks (see ``csv_rows``); one look at all lines finds out which they are, unless
    ``multi_line`` says it.

    Rows with more values than the header, bytes that are no UTF-8 (or not in ``encoding``) and an open
    quote at the end of a file are refused, with file and line; with ``report`` they are left out,
    and ``rejected_rows`` has them. ``with_path`` names a column for the file path. ``stage`` writes
    the parsed rows to the shared folder once, in columns: profiling reads each column by itself, and
    would else parse the files again for every one of them.
    """
    df, _, _ = _read_text(spark, paths, fmt, multi_line, with_path, encoding, report)
    return materialize(df, "text")[0] if stage else df


def rejected_rows(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool | None = None, encoding: str | None = None
) -> DataFrame:
    """What ``read_text_table`` leaves out of CSV files: file_path, line (from 1), reason, record."""
    return _read_text(spark, paths, "csv", multi_line, None, encoding, True)[1]


def _read_text(
    spark: SparkSession, paths: str | Sequence[str], fmt: str | None, multi_line: bool | None, with_path: str | None,
    encoding: str | None, report: bool,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """The table, the rejected rows, and the files both come from."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no files to read")
    for p in paths:
        if not path_exists(spark, p):
            raise FileNotFoundError(f"File not found: {p}")
    kinds = {fmt or ("csv" if _suffix(p) in CSV_SUFFIXES else "parquet" if _suffix(p) in SNAPSHOT_SUFFIXES else "")
             for p in paths}
    if len(kinds) != 1 or not kinds <= {"csv", "parquet"}:
        raise ValueError(f"Unsupported file format: {sorted({_suffix(p) for p in paths})}")
    none = spark.createDataFrame([], csv_rows.REJECTED)
    if kinds == {"parquet"}:
        df = read_snapshot_as_text(spark, paths, with_path)
        return df, none, [csv_rows.path_of(spark, f) for f in df.inputFiles()]
    found = csv_rows.layouts(spark, paths, encoding, multi_line)
    groups: dict[tuple, list[csv_rows.Layout]] = {}
    for layout in found:
        groups.setdefault((layout.plain, layout.columns), []).append(layout)
    parts, rejected = [], none
    for (plain, columns), group in groups.items():
        if plain:
            parts.append(_plain_csv(spark, [csv_rows.path_of(spark, g.file) for g in group], columns, with_path, encoding))
            continue
        good, bad, _ = csv_rows.read_layout(spark, group, encoding, with_path)
        if not report:
            some = bad.orderBy("file_path", "line").limit(3).collect()
            if some:
                told = "; ".join(f"{r.file_path} line {r.line}: {r.reason}" for r in some)
                raise ValueError(f"rows that cannot be read: {told}")
        parts.append(good)
        rejected = rejected.unionByName(bad)
    return stack_by_name(parts), rejected, [csv_rows.path_of(spark, layout.file) for layout in found]


def _plain_csv(
    spark: SparkSession, files: Sequence[str], columns: Sequence[str], with_path: str | None, encoding: str | None
) -> DataFrame:
    """Files of one header whose lines are their rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    options = {
        "header": True, "escape": '"', "encoding": encoding or "UTF-8",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    return blanks_for_nulls(_with_path(spark.read.schema(schema).options(**options).csv(list(files)), with_path))


def _each(paths: Sequence[str], look: Callable[[str], object]) -> list:
    """What a look at the head of each file finds; several files at a time."""
    with ThreadPool(min(8, len(paths))) as pool:
        return pool.map(look, paths)


def _alike(paths: Sequence[str], kinds: Sequence) -> list[list[str]]:
    groups: dict[object, list[str]] = {}
    for p, kind in zip(paths, kinds):
        groups.setdefault(kind, []).append(p)
    return list(groups.values())


def _with_path(df: DataFrame, with_path: str | None) -> DataFrame:
    if not with_path:
        return df
    return df.select(*[ref(c) for c in df.columns], csv_rows.real_path(F.col("_metadata.file_path")).alias(with_path))


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text; missing values become ``''`` and stay missing."""
    out = []
    for f in df.schema.fields:
        c = ref(f.name)
        plain = isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.BinaryType)
        text = c.cast("string") if plain else F.to_json(c)
        out.append(F.coalesce(text, F.lit("")).alias(f.name))
    return df.select(*out)


def read_snapshot_as_text(
    spark: SparkSession, paths: str | Sequence[str], with_path: str | None = None
) -> DataFrame:
    """Read saved tables and turn every column into text; tables of different columns are stacked by
    name, and a column that a table lacks is null in its rows. Of a snapshot the current version is read."""
    paths = [current_path(spark, p) for p in ([paths] if isinstance(paths, str) else paths)]
    reader = spark.read.option("mergeSchema", True)
    schemas = _each(paths, lambda p: reader.parquet(p).schema.json())
    return stack_by_name(
        [as_text(_with_path(reader.parquet(*same), with_path)) for same in _alike(paths, schemas)]
    )


def label_sources(
    df: DataFrame, path_column: str, source: str = SOURCE, files: Sequence[str] | None = None
) -> DataFrame:
    """Add the label of each row's file: its stem, or its directory if two files share the stem.

    ``files`` lists the files where the caller knows them; otherwise a scan of the path column
    does, combined map-side. The repeated stems are broadcast if they are few, else joined by
    shuffle.
    """
    stem = unused_name(df, "__stem")
    if files is not None:
        paths = local_table(df.sparkSession, [(f,) for f in sorted(set(files))], "__path string")
    else:
        paths = df.select(ref(path_column).alias("__path")).distinct()
    repeated = (
        paths.groupBy(path_stem("__path").alias("__repeated"))
        .agg(F.count(F.lit(1)).alias("__files"))
        .filter(F.col("__files") > 1)
        .select("__repeated")
    )
    side = broadcast_if_small(repeated)
    labelled = df.withColumn(stem, path_stem(quoted(path_column))).join(
        side, F.col(stem) == F.col("__repeated"), "left"
    )
    label = F.when(F.col("__repeated").isNull(), F.col(stem)).otherwise(path_parent(quoted(path_column)))
    return labelled.withColumn(source, label).drop(stem, "__repeated")


def read_sources(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str | None = None,
    multi_line: bool | None = None,
    stage: bool = False,
    encoding: str | None = None,
    report: bool = False,
) -> DataFrame:
    """All files as one text table with ``file_path`` and the ``source_file`` label; options as for
    ``read_text_table``."""
    rows, _, files = _read_text(spark, paths, fmt, multi_line, "file_path", encoding, report)
    if stage:
        rows, _ = materialize(rows, "text")
    return label_sources(rows, "file_path", files=files)


def snapshot_path(folder: str, label: str, kind: str) -> str:
    """``<folder>/<label>_transformed`` or ``<folder>/<label>_cleaned``."""
    if kind not in ("transformed", "cleaned"):
        raise ValueError(f"unknown snapshot kind {kind!r}")
    return f"{folder.rstrip('/')}/{label}_{kind}"


def write_typed_snapshot(df: DataFrame, folder: str, label: str) -> str:
    """Save the table after casting as the next version of its snapshot; returns that version's path."""
    return write_snapshot(df, snapshot_path(folder, label, "transformed"))


def write_cleaned_snapshot(
    df: DataFrame, folder: str, label: str, partition_by: Sequence[str] = ()
) -> str:
    """Save the cleaned table, partitioned by source where it has several; returns its version's path.

    Rows are rebalanced by source before the write: few files per source, and a hot source is
    split over as many tasks as its size asks for.
    """
    return write_snapshot(df, snapshot_path(folder, label, "cleaned"), partition_by)
