"""Where intermediate tables go: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder.

    Only a local master may do without: it gets a temporary folder, removed when Python ends. On a
    cluster a machine-local path would be lost with its machine, so a missing setting is an error.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all machines can reach")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="mendtable-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back, so later passes do not redo its work.

    Unlike a cached table it survives the loss of an executor without recomputation. The path comes
    with it, for ``discard``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
