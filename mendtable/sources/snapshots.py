"""Snapshots that are whole at any time: a new version is written to a folder of its own, and readers see it
once a small pointer file names it.

A writer that stops midway leaves a folder nobody points to, and the old version readable. The manifest of a
version holds its schema and number of rows, so that reading infers nothing. The pointer is written beside
its place and moved over it in one step where the file system can; older versions are deleted after that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref

POINTER = "_current.json"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    jvm = spark._jvm
    fresh = f"{path}.{uuid.uuid4().hex}"
    fs, p = _file_system(spark, fresh)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    over = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = over
    context.rename(p, target, options)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return text


def _name(kind: str) -> str:
    return f"{kind}-{uuid.uuid4().hex}"


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Save a table as the next version of a snapshot; the folder of that version."""
    spark, path = df.sparkSession, path.rstrip("/")
    version = _name("version")
    data = f"{path}/{version}"
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("n"))
    writer = rows.hint("rebalance", *[ref(p) for p in partition_by]).write.partitionBy(*partition_by) if partition_by else rows.write
    writer.parquet(data)
    try:
        n = counted.get["n"]
    except (KeyError, Py4JError):  # the optimizer found the table empty and dropped the observation
        n = spark.read.schema(df.schema).parquet(data).count()
    # columns a snapshot is partitioned by come last in its files
    fields = [f for f in df.schema if f.name not in partition_by] + [df.schema[p] for p in partition_by]
    _write_text(spark, f"{path}/{POINTER}", json.dumps({"version": version, "rows": n, "schema": T.StructType(fields).jsonValue()}))
    _clear(spark, path, version)
    return data


def _clear(spark: SparkSession, path: str, keep: str) -> None:
    fs, p = _file_system(spark, path)
    for status in fs.listStatus(p):
        found = status.getPath()
        if found.getName() not in (keep, POINTER) and found.getName().startswith(("version-", f"{POINTER}.")):
            fs.delete(found, True)


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What the pointer says: version, rows and schema; None where there is no snapshot."""
    text = _read_text(spark, f"{path.rstrip('/')}/{POINTER}")
    return None if text is None else json.loads(text)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a snapshot."""
    found = manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no snapshot: {path}")
    schema = T.StructType.fromJson(found["schema"])
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{found['version']}")


def current_path(spark: SparkSession, path: str) -> str:
    """Where the data of a snapshot are; any other path as it is."""
    found = manifest(spark, path)
    return path if found is None else f"{path.rstrip('/')}/{found['version']}"
