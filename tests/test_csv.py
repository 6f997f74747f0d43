"""CSV reading: fields with line breaks in files read by many tasks, headers as they stand, rejected rows."""

import csv
import io
import random

import pandas as pd
import pytest
from physical import physical_plan

from mendtable.sources import csv_rows, tables


def by_pandas(data):
    df = pd.read_csv(io.BytesIO(data), dtype=str, keep_default_na=False)
    return list(df.columns), sorted(map(tuple, df.values.tolist()))


def by_spark(spark, path, **options):
    df = tables.read_text_table(spark, str(path), **options)
    return df.columns, sorted(map(tuple, df.collect()))


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def written(rows, **options):
    out = io.StringIO()
    csv.writer(out, **options).writerows(rows)
    return out.getvalue().encode()


CASES = {
    "breaks": b'a,b,c\n1,"x\ny ""q"" z",\n\n2,"\n\n\n",w\n"3\n",,"last\nfield"\n4,5,6\n',
    "returns": b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n',
    "stray quotes": b'a,b\n5" pipe,x\n"q" tail,"a ""b"" c"d"e\n,"\n"\n""x,""""\n"",y"y\n',
    "only breaks": b'a\n"\n"\n"\n\n"\nx\n',
    "no last break": b'a,b\n1,"two\nlines"',
    "blank lines": b'\n\na,b\n\n  \n1,2\n\n"x\n\n",3\n',
    "header breaks": b'"a\nb",c\n1,"2\n3"\n',
    "short rows": b'a,b,c\n1\n"2\n",3\n4,5,6\n',
    "plain": b"a,b\n1,2\nNA, x \n,\nnull,nan\n",
    "spaces": b"a,b\n \t ,1\n   \n2,\n",
    "names": b"a,A,a,,b,a.1,\n1,2,3,4,5,6,7\n",
    "bom": "﻿a,b\n1,é\n".encode(),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("multi_line", [None, True])
def test_as_pandas(spark, tmp_path, small_blocks, name, multi_line):
    path = tmp_path / "t.csv"
    path.write_bytes(CASES[name])
    assert by_spark(spark, path, multi_line=multi_line) == by_pandas(CASES[name])


def test_random_files_in_small_blocks(spark, tmp_path, small_blocks):
    dice = random.Random(4)
    for case in range(6):
        letters = dice.choice(['ab ,"\n', '"\n,', 'xyz\n"é🙂', "ab,", '"'])
        rows = [["a", "b", "c"]] + [
            ["".join(dice.choice(letters) for _ in range(dice.randint(1, 30))) for _ in range(3)] for _ in range(40)
        ]
        quoting = dice.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
        data = written(rows, quoting=quoting, lineterminator=dice.choice(["\n", "\r\n"]))
        path = tmp_path / f"t{case}.csv"
        path.write_bytes(data)
        columns, got = by_spark(spark, path)
        assert columns == rows[0] and got == sorted(map(tuple, rows[1:]))


def test_many_tasks_read_a_file_with_breaks(spark, tmp_path, small_blocks):
    path = tmp_path / "t.csv"
    path.write_bytes(written([["a", "b"]] + [[i, f"line\n{i}"] for i in range(200)]))
    lines = csv_rows._lines(spark, [str(path)], None)
    assert lines.rdd.getNumPartitions() > 5
    good, bad, scratch = csv_rows.read_layout(spark, csv_rows.layouts(spark, [str(path)]))
    assert len(scratch) == 3 and bad.count() == 0
    assert sorted(good.collect()) == sorted((str(i), f"line\n{i}") for i in range(200))
    assert "Python" not in physical_plan(csv_rows.records(spark, [f"file:{path}"], None, []))


def test_a_long_field_crosses_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'say "{i}", then' for i in range(150))
    path = tmp_path / "t.csv"
    path.write_bytes(written([["a", "b"], ["1", long], ["2", "x"], [long, long], ["3", ""]]))
    assert by_spark(spark, path) == (["a", "b"], sorted([("1", long), ("2", "x"), (long, long), ("3", "")]))


REJECTS = b'a,b\n1,2\n1,2,3\n"x\ny",4,5\n6,caf\xe9\n7,"8\n9"\n10,"never\nclosed\n'


def test_rejected_rows(spark, tmp_path, small_blocks):
    path = tmp_path / "t.csv"
    path.write_bytes(REJECTS)
    with pytest.raises(ValueError, match="line 3: more values than the header"):
        tables.read_text_table(spark, str(path))
    assert by_spark(spark, path, report=True) == (["a", "b"], [("1", "2"), ("7", "8\n9")])
    bad = tables.rejected_rows(spark, str(path))
    assert bad.columns == ["file_path", "line", "reason", "record"]
    got = [(r.line, r.reason) for r in bad.orderBy("line").collect()]
    assert got == [(3, csv_rows.WIDE), (4, csv_rows.WIDE), (6, csv_rows.NOT_TEXT), (9, csv_rows.OPEN)]
    shown = {r.line: r.record for r in bad.select("line", "record").filter("line <> 6").collect()}
    assert shown == {3: "1,2,3", 4: '"x\ny",4,5', 9: '10,"never'}
    assert all(f.file_path.endswith("t.csv") for f in bad.select("file_path").collect())


def test_other_encodings(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('a,b\né,"ß\nü"\n'.encode("latin-1"))
    with pytest.raises(ValueError, match="no text"):
        tables.read_text_table(spark, str(path))
    assert by_spark(spark, path, encoding="ISO-8859-1") == (["a", "b"], [("é", "ß\nü")])
    path.write_bytes("a,b\né,ß\n".encode("latin-1"))
    assert by_spark(spark, path, encoding="ISO-8859-1") == (["a", "b"], [("é", "ß")])


def test_files_of_several_layouts(spark, tmp_path):
    texts = {"one a+b%": "k,v\n1,x\n", "two": 'v,k\n"y\nz",2\n', "three": "k,V\n3,w\n", "four": 'k,v\n4,"p\nq"\n'}
    paths = []
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
        paths.append(str(tmp_path / f"{name}.csv"))
    df = tables.read_sources(spark, paths)
    got = {r.source_file: (r.k, r.v, r.V) for r in df.collect()}
    assert got == {"one a+b%": ("1", "x", None), "two": ("2", "y\nz", None), "three": ("3", None, "w"), "four": ("4", "p\nq", None)}


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"f{i}.csv").write_text(f"k,v{i % 3}\n{i},x\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "")
    try:
        found = csv_rows.layouts(spark, [str(tmp_path / f"f{i}.csv") for i in range(40)])
        # adaptive execution runs each stage as a job
        assert len(tracker.getJobIdsForGroup("headers")) <= 5
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(found) == 40 and {f.columns for f in found} == {("k", f"v{j}") for j in range(3)} and all(f.plain for f in found)


def test_empty_files(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n")
    assert by_spark(spark, path) == (["a", "b"], [])
    path.write_text("\n\n")
    with pytest.raises(ValueError, match="no header"):
        tables.read_text_table(spark, str(path))
    path.write_text("")
    with pytest.raises(ValueError, match="no header"):
        tables.read_text_table(spark, str(path))
