"""Inference rules just at and past their thresholds."""

import pytest

from mendtable.operators.frequencies import first_values
from mendtable.operators.infer import infer_types, reconcile_types, resolve_target_type


def inferred(text, **columns):
    rows = infer_types(text(**columns), order_by=["n"]).orderBy("column_index").collect()
    return {r.column_name: r for r in rows}


def kind(text, name, values):
    r = inferred(text, **{name: values})[name]
    return r.inferred_type, round(r.confidence, 6)


def test_empty_column(text):
    r = inferred(text, c=["", "", ""])["c"]
    assert (r.inferred_type, r.confidence, r.sample_values) == ("text", 1.0, [])
    assert r.reasoning == "All 3 values are empty or missing. Defaulting to text."


def test_table_without_rows(spark):
    rows = infer_types(spark.createDataFrame([], "a string, b string")).collect()
    assert [(r.inferred_type, r.confidence) for r in rows] == [("text", 1.0)] * 2


@pytest.mark.parametrize("repeats, expected", [(0, "identifier"), (1, "integer")])
def test_identifier_ratio_is_strict(text, repeats, expected):
    values = [str(1000 + i) for i in range(20 - repeats)] + ["1000"] * repeats  # 20/20, then 19/20
    assert kind(text, "order_id", values)[0] == expected


@pytest.mark.parametrize("name, expected", [("paid", "identifier"), ("monkey", "identifier"), ("amount", "integer")])
def test_identifier_name_is_a_substring_test(text, name, expected):
    assert kind(text, name, [str(i * 3) for i in range(5)])[0] == expected


@pytest.mark.parametrize("pair", [("t", "F"), (" true", "FALSE "), ("yes", "no"), ("y", "N"), ("0", "1")])
def test_boolean_pairs(text, pair):
    assert kind(text, "c", [*pair, "", pair[0]]) == ("boolean", 0.95)


def test_single_word_is_boolean(text):
    assert kind(text, "c", ["1", "1"])[0] == "boolean"


@pytest.mark.parametrize("values", [["t", "no"], ["t", "f", " "], ["0", "1", "2"]])
def test_not_boolean(text, values):
    assert kind(text, "c", values)[0] != "boolean"


def test_numeric_ratio_is_strict(text):
    nine = [str(i) for i in range(9)] + ["x"]
    assert kind(text, "c", nine)[0] == "text"
    assert kind(text, "c", [str(i) for i in range(19)] + ["x"]) == ("integer", 0.95)


def test_integer_ignores_infinity(text):
    assert kind(text, "c", ["1", "2.0", "3e2", "inf"])[0] == "integer"
    assert kind(text, "c", ["inf", "-inf", "inf"])[0] == "float"
    assert kind(text, "c", ["1", "2.5", "7"])[0] == "float"


def test_date_ratio_is_strict(text):
    days = [f"2024-01-{d:02}" for d in range(1, 9)]
    assert kind(text, "c", days + ["soon", "later"])[0] == "text"
    assert kind(text, "c", days + ["01/09/2024", "later"]) == ("datetime", 0.9)


def test_only_the_first_fifty_decide_dates(text):
    values = ["2024-01-01"] * 41 + ["x"] * 9 + [f"word {i}" for i in range(1000)]
    assert kind(text, "c", values) == ("datetime", 0.82)


@pytest.mark.parametrize(
    "distinct, rows, expected", [(20, 401, "categorical"), (20, 400, "text"), (21, 1000, "text")]
)
def test_categories(text, distinct, rows, expected):
    assert kind(text, "c", [f"v{i % distinct}" for i in range(rows)])[0] == expected


def test_empty_counts_as_a_value(text):
    r = inferred(text, c=["a", "", "", "b"])["c"]
    assert r.unique_count == 3 and r.non_empty == 2


def test_long_texts_are_told_apart(text):
    long_ = "x" * 500
    r = inferred(text, c=[long_ + "a", long_ + "b", long_ + "b", "1" * 80])["c"]
    assert r.unique_count == 3 and r.inferred_type == "text"
    assert r.sample_values[0] == long_ + "a"


def test_long_numbers_are_numbers(text):
    assert kind(text, "c", ["0" * 80 + "1", "5"])[0] == "integer"


def test_groups_are_profiled_apart(spark):
    rows = [("a", str(i)) for i in range(5)] + [("b", w) for w in ("x", "y", "z")]
    df = spark.createDataFrame(rows, "g string, v string")
    got = {r.g: r.inferred_type for r in infer_types(df, by=["g"]).collect()}
    assert got == {"a": "integer", "b": "text"}


def test_more_samples_on_request(text):
    df = text(c=[f"v{i}" for i in range(30)])
    (r,) = infer_types(df, order_by=["n"], samples=12).collect()
    assert r.sample_values == [f"v{i}" for i in range(12)]


def test_first_values_by_group(spark):
    df = spark.createDataFrame([(g, i, f"{g}{i}") for g in "ab" for i in range(9)], "g string, n int, v string")
    got = first_values(df, ["v"], 2, ["n"], by=["g"]).collect()
    assert sorted((r.g, r.place, r.value) for r in got) == [("a", 1, "a0"), ("a", 2, "a1"), ("b", 1, "b0"), ("b", 2, "b1")]


def test_reconcile_and_resolve(spark, text):
    profile = infer_types(text(a=["1", "2"], b=["x", "y"], c=["2024-01-01", "2024-01-02"]), order_by=["n"])
    opinion = spark.createDataFrame(
        [("a", "integer", 0.8, "digits"), ("b", "categorical", 0.99, "few"), ("c", "datetime", 0.79, "dashes")],
        "column_name string, suggested_type string, confidence double, reasoning string",
    )
    got = {r.column_name: r for r in resolve_target_type(reconcile_types(profile, opinion)).collect()}
    assert (got["a"].confidence, got["a"].user_approved, got["a"].target_type) == (0.8, True, "integer")
    assert (got["b"].confidence, got["b"].user_approved, got["b"].target_type) == (0.5, None, None)
    assert (got["c"].confidence, got["c"].needs_review) == (0.79, True)
