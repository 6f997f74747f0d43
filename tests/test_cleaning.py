"""Casts, duplicates, nil repair: edge cases the queries do not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mendtable.functions.columns import small_table
from mendtable.operators import duplicates
from mendtable.operators.casts import apply_casts, plan_casts
from mendtable.operators.nils import (
    allowed_actions, check_actions, fit_nils, nil_report, repair_nils,
)
from mendtable.operators.statistics import column_statistics


def values(df, c):
    return [r[0] for r in df.orderBy("n").select(c).collect()]


def test_integer_cast_is_all_or_nothing(text):
    df = text(a=["1", "x", "2.0"], b=["1", "2.5", "x"], c=["1", "inf", "2"])
    out = apply_casts(df, {"a": "integer", "b": "integer", "c": "integer"})
    assert values(out, "a") == [1, None, 2]
    assert values(out, "b") == ["1", "2.5", "x"]
    assert values(out, "c") == ["1", "inf", "2"]


def test_unknown_columns_and_types_are_left_alone(text):
    df = text(a=["1"])
    steps = plan_casts(df, {"a": "complex", "ghost": "float"})
    assert [s.target for s in steps] == [None, None]
    assert [s.message for s in steps] == [
        "Unknown type 'complex' - no transformation applied", "ERROR: Column 'ghost' not found",
    ]
    assert apply_casts(df, {"a": "complex"}).collect() == df.collect()


def test_semantic_type_travels_as_metadata(text):
    out = apply_casts(text(a=["007"], b=["x"]), {"a": "identifier", "b": "category"})
    assert out.schema["a"].metadata == {"semantic_type": "identifier"}
    assert out.schema["b"].metadata == {"semantic_type": "categorical"}
    assert values(out, "a") == ["007"]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "")], "`unit price` string, `a.b` string")
    out = apply_casts(df, {"unit price": "integer", "a.b": "text"})
    assert out.schema["unit price"].dataType.simpleString() == "bigint"
    assert [r.nil_count for r in nil_report(out).collect()] == [1]


def test_duplicates_treat_null_and_nan_as_equal(spark):
    nan = float("nan")
    rows = [(None, nan, 0.0), (None, nan, -0.0), (1, nan, 0.0), (1, 2.0, 0.0), (1, 2.0, 0.0), (1, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    r = duplicates.duplicate_count(df).first()
    assert (r.total_rows, r.duplicate_count, r.duplicate_percent) == (6, 3, 50.0)
    assert duplicates.drop_duplicates(df).count() == 3
    assert duplicates.duplicate_rows(df).count() == 3


def test_many_copies_come_out_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "COPY_CHUNK", 7)
    df = spark.range(50).select(F.lit("x").alias("v")).unionAll(spark.createDataFrame([("y",)], "v string"))
    out = duplicates.duplicate_rows(df)
    assert [r.v for r in out.collect()] == ["x"] * 49


@pytest.mark.parametrize("few", [10_000, 0])
def test_duplicates_by_digest(spark, monkeypatch, few):
    """With the repeated rows broadcast, and with too many of them for that."""
    monkeypatch.setattr(duplicates, "small_table", lambda df: small_table(df, few))
    nan = float("nan")
    rows = [("w" * 200, nan, None), ("w" * 200, nan, None), ("w" * 201, nan, None), (None, 0.0, 1), (None, -0.0, 1)]
    df = spark.createDataFrame(rows, "t string, v double, n int")
    assert duplicates.drop_duplicates(df, long_text=True).count() == 3
    assert sorted(r.t or "" for r in duplicates.duplicate_rows(df).collect()) == ["", "w" * 200]
    none = df.filter("false")
    assert duplicates.drop_duplicates(none, long_text=True).count() == duplicates.duplicate_rows(none).count() == 0


def test_no_rows_no_duplicates(spark):
    r = duplicates.duplicate_count(spark.createDataFrame([], "a int")).first()
    assert r is None or (r.duplicate_count, r.duplicate_percent) == (0, 0.0)


def test_long_texts_are_compared_whole(spark):
    long_ = "z" * 5000
    df = spark.createDataFrame([(long_ + "1",), (long_ + "2",), (long_ + "2",)], "v string")
    assert duplicates.duplicate_count(df).first().duplicate_count == 1


def fixed(spark, rows, schema, actions):
    df = spark.createDataFrame(rows, schema)
    fit = fit_nils(df, actions)
    return repair_nils(df, fit), fit


def test_fractional_median_promotes_an_integer_column(spark):
    out, fit = fixed(spark, [(0, 1), (1, 2), (2, None)], "n int, v bigint", {"v": "fill_median"})
    assert out.schema["v"].dataType.simpleString() == "double"
    assert values(out, "v") == [1.0, 2.0, 1.5]
    assert "promoted to float" in fit.steps[0].message


def test_whole_median_keeps_an_integer_column(spark):
    out, _ = fixed(spark, [(0, 1), (1, 3), (2, None)], "n int, v bigint", {"v": "fill_median"})
    assert out.schema["v"].dataType.simpleString() == "bigint" and values(out, "v") == [1, 3, 2]


def test_median_of_text_changes_nothing(spark):
    out, fit = fixed(spark, [(0, "a"), (1, "")], "n int, v string", {"v": "fill_median"})
    assert values(out, "v") == ["a", ""] and fit.steps[0].message.startswith("ERROR")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_median_of_moments(spark, kind):
    rows = [(0, "2024-01-01"), (1, "2024-01-04"), (2, None)]
    df = spark.createDataFrame(rows, "n int, v string").withColumn("v", F.col("v").cast(kind))
    out = repair_nils(df, fit_nils(df, {"v": "fill_median"}))
    assert out.schema["v"].dataType.simpleString() == kind
    assert values(out, F.col("v").cast("timestamp_ntz"))[2] == dt.datetime(2024, 1, 2, 12)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "boolean", "decimal(20,2)", "int", "bigint", "double"])
def test_most_common_of_any_type(spark, kind):
    texts = {"boolean": ["true", "false"], "date": ["2024-01-02", "2024-01-03"]}.get(
        kind, ["2024-01-02 01:00:00", "2024-01-03 00:00:00"] if kind.startswith("timestamp") else ["10", "9"]
    )
    rows = [(0, texts[0]), (1, texts[0]), (2, texts[1]), (3, None)]
    df = spark.createDataFrame(rows, "n int, v string").withColumn("v", F.col("v").cast(kind))
    out = repair_nils(df, fit_nils(df, {"v": "fill_most_common"}))
    got = values(out, "v")
    assert got[3] == got[0] and out.schema["v"].dataType.simpleString() == kind


def test_most_common_ties_go_to_the_smallest_number(spark):
    out, _ = fixed(spark, [(0, 10), (1, 9), (2, None)], "n int, v bigint", {"v": "fill_most_common"})
    assert values(out, "v") == [10, 9, 9]


def test_most_common_of_nothing_is_unknown(spark):
    out, _ = fixed(spark, [(0, None), (1, None)], "n int, v bigint", {"v": "fill_most_common"})
    assert values(out, "v") == ["Unknown", "Unknown"]


def test_unknown_turns_other_types_into_text(spark):
    out, _ = fixed(spark, [(0, True), (1, None)], "n int, v boolean", {"v": "fill_unknown"})
    assert values(out, "v") == ["true", "Unknown"]


def test_zero_in_text_and_boolean(spark):
    out, _ = fixed(spark, [(0, "a", True), (1, " ", None)], "n int, t string, b boolean", {"t": "fill_zero", "b": "fill_zero"})
    assert values(out, "t") == ["a", "0"] and values(out, "b") == [True, False]


def test_a_column_without_nils_keeps_its_type(spark):
    out, fit = fixed(spark, [(0, True)], "n int, v boolean", {"v": "fill_unknown"})
    assert out.schema["v"].dataType.simpleString() == "boolean" and fit.steps[0].nil_count == 0


def test_later_columns_see_earlier_dropped_rows(spark):
    rows = [(0, 1, 10.0), (1, None, 1000.0), (2, 2, 20.0), (3, 3, None)]
    out, _ = fixed(spark, rows, "n int, a int, b double", {"a": "drop_rows", "b": "fill_median"})
    assert values(out, "b") == [10.0, 20.0, 15.0]
    rows = [(0, 10.0, 1), (1, 1000.0, None), (2, 20.0, 2), (3, None, 3)]
    out, _ = fixed(spark, rows, "n int, b double, a int", {"a": "drop_rows", "b": "fill_median"})
    assert values(out, "b") == [10.0, 20.0, 20.0]


def test_unknown_action_is_a_message_only(spark):
    out, fit = fixed(spark, [(0, None)], "n int, v int", {"v": "guess"})
    assert values(out, "v") == [None]
    assert fit.steps[0].message == "Unknown action 'guess' for nil value handling"


def test_actions_must_suit_the_column(spark):
    df = spark.createDataFrame([(1, "a")], "v int, t string")
    check_actions(df, {"v": "fill_median", "t": "fill_unknown", "ghost": "fill_zero"})
    with pytest.raises(ValueError):
        check_actions(df, {"t": "fill_median"})
    assert "fill_zero" in allowed_actions(df.schema["v"].dataType)


def test_fills_per_group(spark):
    rows = [(0, "a", 1.0, "x"), (1, "a", None, "x"), (2, "b", 5.0, None), (3, "b", None, "y"), (4, "b", 7.0, "z"), (5, "c", None, None)]
    df = spark.createDataFrame(rows, "n int, g string, v double, t string")
    fit = fit_nils(df, {"v": "fill_median", "t": "fill_most_common"}, ["g"])
    out = repair_nils(df, fit)
    assert values(out, "v") == [1.0, 1.0, 5.0, 6.0, 7.0, None]
    assert values(out, "t") == ["x", "x", "y", "y", "z", "Unknown"]


def test_repair_leaves_no_nils_and_is_idempotent(spark):
    rows = [(i, None if i % 3 == 0 else float(i), "" if i % 4 == 0 else "abc"[i % 3]) for i in range(40)]
    actions = {"v": "fill_median", "t": "fill_most_common"}
    once, _ = fixed(spark, rows, "n int, v double, t string", actions)
    assert nil_report(once).count() == 0
    assert sorted(repair_nils(once, fit_nils(once, actions)).collect()) == sorted(once.collect())


def test_statistics_edge_cases(spark):
    rows = [(1, None, float("nan"), None, True), (1, None, 2.0, "", False)]
    df = spark.createDataFrame(rows, "one int, none double, nan double, t string, b boolean")
    s = {r.column_name: r for r in column_statistics(df).collect()}
    assert (s["one"].unique_count, s["one"].std, s["one"].outlier_count) == (1, 0.0, 0)
    assert (s["none"].non_null_count, s["none"].min, s["none"].outlier_count) == (0, None, None)
    assert (s["nan"].null_count, s["nan"].std, s["nan"].median) == (1, None, 2.0)
    assert (s["t"].unique_count, s["t"].null_count, s["t"].has_outliers) == (1, 1, False)
    assert (s["b"].unique_count, s["b"].mean, s["b"].outlier_count) == (2, None, 0)


def test_statistics_tell_huge_integers_apart(spark):
    df = spark.createDataFrame([(2**60,), (2**60 + 1,), (2**60,), (5,)], "v bigint")
    assert column_statistics(df).first().unique_count == 3


def test_statistics_of_all_types(spark):
    df = spark.sql(
        "select cast(v as decimal(38,10)) as d, date'2024-01-01' + cast(v as int) as day, array(v) as a,"
        " timestamp'2024-01-01' as ts, cast(cast(v as string) as binary) as bin from values (1), (2), (2) t(v)"
    )
    s = {r.column_name: r.unique_count for r in column_statistics(df).collect()}
    assert s == {"d": 2, "day": 2, "a": 2, "ts": 1, "bin": 2}
    assert {r.column_name: r.max for r in column_statistics(df).collect()}["d"] == 2.0


def test_rows_are_distinct_plus_duplicates(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    r = duplicates.duplicate_count(df).first()
    assert r.total_rows == df.distinct().count() + r.duplicate_count
