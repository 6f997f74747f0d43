"""Profiles of files that are saved one by one and merged."""

import pytest
from pyspark.sql import functions as F

from mendtable.operators.frequencies import value_frequencies
from mendtable.operators.profiles import _facts, merged_statistics, save_profile
from mendtable.operators.quantiles import quantiles_of_counts, quantiles_of_shares
from mendtable.operators.statistics import column_statistics

NAN = float("nan")
FIRST = [(1, 2.5, "a", True), (2, NAN, None, None), (2, 1000.0, "b" * 100, False), (None, -3.0, "", True)]
SECOND = [(2, 4.0, "a", False), (7, 4.0, "b" * 100, None), (1 << 40, 2.5, "c", None)]
TYPES = "k long, x double, s string, f boolean"


def told(df):
    """Rows with twelve digits of each float, as sums of files round otherwise than those of one table."""
    return [
        tuple(float(f"{v:.12g}") if isinstance(v, float) else v for v in r)
        for r in sorted(df.collect(), key=lambda r: r.column_index)
    ]


def test_merged_files_are_as_one_table(spark, tmp_path):
    path, one, two = str(tmp_path / "p"), spark.createDataFrame(FIRST, TYPES), spark.createDataFrame(SECOND, TYPES)
    save_profile(one, path, "a")
    assert told(merged_statistics(spark, path)) == told(column_statistics(one))
    save_profile(two, path, "b")
    save_profile(one.limit(0), path, "c")
    both = column_statistics(one.unionAll(two))
    found = merged_statistics(spark, path)
    assert found.columns == both.columns and told(found) == told(both)
    assert told(merged_statistics(spark, path, ["b"])) == told(column_statistics(two))
    # saved again, a file counts once
    save_profile(one, path, "a")
    assert told(merged_statistics(spark, path)) == told(both)
    save_profile(two, path, "a")
    assert told(merged_statistics(spark, path)) == told(column_statistics(two.unionAll(two)))


def test_columns_and_types_that_differ(spark, tmp_path):
    path = str(tmp_path / "p")
    one = spark.createDataFrame([(1, "x"), (2, "y")], "`odd.name` int, s string")
    two = spark.createDataFrame([(2.0, 9), (3.5, 9), (NAN, None)], "`odd.name` double, other long")
    save_profile(one, path, "a")
    save_profile(two, path, "b")
    assert told(merged_statistics(spark, path)) == told(column_statistics(one.unionByName(two, allowMissingColumns=True)))
    save_profile(spark.createDataFrame([("t",)], "other string"), path, "c")
    with pytest.raises(ValueError, match="'other'.*bigint, string"):
        merged_statistics(spark, path)


def test_empty_and_all_null(spark, tmp_path):
    path = str(tmp_path / "p")
    none = spark.createDataFrame([(None, None), (None, None)], "x double, s string")
    save_profile(none.limit(0), path, "a")
    assert told(merged_statistics(spark, path)) == told(column_statistics(none.limit(0)))
    save_profile(none, path, "b")
    for approx in (False, True):
        assert told(merged_statistics(spark, path, approx=approx)) == told(column_statistics(none))


def test_sketches_alone(spark, sf_dir, tmp_path):
    path, lines = str(tmp_path / "p"), spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for k in range(3):
        save_profile(lines.filter(F.col("l_orderkey") % 3 == k), path, str(k), exact=False)
    with pytest.raises(ValueError, match="approx"):
        merged_statistics(spark, path)
    exact = {r.column_name: r for r in column_statistics(lines).collect()}
    found = {r.column_name: r for r in merged_statistics(spark, path, approx=True).collect()}
    assert set(found) == set(exact)
    n = lines.count()
    for c, want in exact.items():
        got = found[c]
        assert (got.non_null_count, got.null_count, got.min, got.max) == (want.non_null_count, want.null_count, want.min, want.max)
        assert got.unique_count == pytest.approx(want.unique_count, rel=0.04)
        if want.mean is not None:
            assert got.mean == pytest.approx(want.mean) and got.std == pytest.approx(want.std) and got.outlier_count is None
            at_most, below = lines.filter(F.col(c) <= got.median).count(), lines.filter(F.col(c) < got.median).count()
            assert below <= 0.502 * n and at_most >= 0.498 * n


def test_quantiles_of_counts_by_group(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 1), ("b", 2.0, 1), ("b", 4.0, 1)]
    found = quantiles_of_counts(spark.createDataFrame(rows, "g string, at double, cnt long"), ["g"], [0.0, 0.5, 1.0])
    assert {r.g: r.q for r in found.collect()} == {"a": [1.0, 1.0, 5.0], "b": [2.0, 3.0, 4.0]}


def test_counted_values_enter_sketches_as_scanned_ones(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(3000).selectExpr(
        "id", "cast(id % 50 AS int) AS i", "IF(id % 7 = 0, double('NaN'), id / 8) AS x", "cast(id / 10 AS float) AS y",
        "cast(id AS decimal(12,2)) AS d", "id % 2 = 0 AS b", "date_add(date'1960-01-01', cast(id AS int)) AS t",
        "timestamp_ntz'1969-12-31 23:59:59.5' + make_dt_interval(0, 0, 0, id / 3) AS n", "timestamp_seconds(id * 999) AS z",
        "IF(id % 3 = 0, repeat(cast(id AS string), 40), cast(id AS string)) AS s", "cast(cast(id AS string) AS binary) AS r",
        "(1L << 53) + id AS large", "array(id % 9) AS a", "cast(NULL AS string) AS none",
    )
    save_profile(df, path, "counted")
    save_profile(df, path, "scanned", exact=False)
    states = spark.read.parquet(path).filter("rows IS NOT NULL").groupBy("column_name")
    told = states.agg(
        F.min(F.hll_sketch_estimate("value_sketch")).alias("one"),
        F.hll_sketch_estimate(F.hll_union_agg("value_sketch")).alias("both"), F.count("value_sketch").alias("n"),
    ).collect()
    assert len(told) == len(df.columns)
    for r in told:
        # sketches of other texts would add up
        assert r.n == 2 and r.both == pytest.approx(r.one, rel=0.02), r.column_name


def test_rows_enter_no_sketch_of_values(spark):
    df = spark.createDataFrame(FIRST, TYPES)
    plan = _facts(df, value_frequencies(df))._jdf.queryExecution().sparkPlan().toString()
    aggregates = [line for line in plan.splitlines() if "ObjectHashAggregate" in line]
    # sums stay apart from sketches, which would keep them out of generated code
    assert aggregates and not any("avg(" in line for line in aggregates)
    assert all("kll_sketch" not in line for line in aggregates if "hll_sketch" in line)


def test_quantiles_of_shares_that_follow_each_other(spark):
    rows = [("a", float(v), 1 + v % 3, v // 4) for v in range(20)] + [("b", 7.0, 5, 4), ("b", 9.0, 1, 5)]
    shares = spark.createDataFrame(rows, "g string, at double, cnt long, __task int")
    counted = shares.drop("__task")
    probs = [0.0, 0.25, 0.5, 0.77, 1.0]
    found = {r.g: r.q for r in quantiles_of_shares(shares, ["g"], probs).collect()}
    every = counted.selectExpr("g", "at", "explode(sequence(1, cnt))")
    want = every.groupBy("g").agg(F.percentile("at", F.array(*map(F.lit, probs))).alias("q")).collect()
    assert set(found) == {"a", "b"} and all(found[r.g] == pytest.approx(r.q) for r in want)
