"""Snapshots: versions, pointer, a writer that fails midway."""

import os

import pytest
from pyspark.sql import functions as F

from mendtable.sources import snapshots
from mendtable.sources.snapshots import manifest, read_snapshot, write_snapshot


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "s")
    assert manifest(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    df = spark.range(10).selectExpr("id", "concat('s', id % 2) AS source", "string(id) AS `odd.name`")
    write_snapshot(df, path)
    assert manifest(spark, path)["rows"] == 10 and sorted(read_snapshot(spark, path).collect()) == sorted(df.collect())
    data = write_snapshot(df.filter("id > 6"), path, ["source"])
    again = read_snapshot(spark, path)
    assert again.columns == ["id", "odd.name", "source"] and again.count() == manifest(spark, path)["rows"] == 3
    assert sorted(os.path.basename(f) for f in os.listdir(path) if not f.startswith(".")) == sorted([snapshots.POINTER, os.path.basename(data)])
    write_snapshot(df.filter("id < 0"), path)
    assert read_snapshot(spark, path).count() == manifest(spark, path)["rows"] == 0
    assert read_snapshot(spark, path).dtypes == df.dtypes


def test_a_writer_that_fails_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    write_snapshot(spark.range(5), path)
    broken = spark.range(100).repartition(4).select(F.expr("CASE WHEN id = 77 THEN raise_error('stop') ELSE id END").cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_snapshot(broken, path)
    assert read_snapshot(spark, path).count() == 5

    def killed(*_):
        raise KeyboardInterrupt

    # the data of the next version is written, the pointer is not
    monkeypatch.setattr(snapshots, "_write_text", killed)
    with pytest.raises(KeyboardInterrupt):
        write_snapshot(spark.range(9), path)
    assert read_snapshot(spark, path).count() == 5
    monkeypatch.undo()
    write_snapshot(spark.range(3), path)
    assert read_snapshot(spark, path).count() == 3 and len([f for f in os.listdir(path) if f.startswith("version-")]) == 1


def test_reading_while_a_version_is_written(spark, tmp_path):
    path = str(tmp_path / "s")
    write_snapshot(spark.range(4), path)
    # a snapshot may be rewritten from itself
    write_snapshot(read_snapshot(spark, path).selectExpr("id + 1 AS id"), path)
    assert sorted(r.id for r in read_snapshot(spark, path).collect()) == [1, 2, 3, 4]
