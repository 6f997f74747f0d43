"""Null and NaN groups, mixed layouts, later tables: where fixtures are clean and data are not."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendtable.functions import columns, parsing
from mendtable.functions.columns import group_join, small_table
from mendtable.operators import nils, quantiles, statistics
from mendtable.operators.duplicates import duplicate_rows
from mendtable.operators.selection import union_sources
from mendtable.operators.summaries import crosstab_counts, crosstab_long
from mendtable.plans.pipeline import apply_plan, clean_many, clean_table, freeze
from mendtable.plans.plan import CleaningPlan, ColumnDecision, fit_plan, load_plan, save_plan
from mendtable.sources import csv_rows, tables
from mendtable.sources.workspace import materialize

NAN = float("nan")


def named(key):
    return "none" if key is None else "odd" if key != key else key


def test_group_join_matches_null_and_nan(spark):
    a = spark.createDataFrame([(None, 1), (NAN, 2), (1.0, 3), (5.0, 4)], "g double, a int")
    b = spark.createDataFrame([(None, 10), (NAN, 20), (1.0, 30), (7.0, 40)], "g double, b int")
    got = {named(r.g): (r.a, r.b) for r in group_join(a, b, ["g"], "full").collect()}
    assert got == {"none": (1, 10), "odd": (2, 20), 1.0: (3, 30), 5.0: (4, None), 7.0: (None, 40)}


def test_repair_by_group_keeps_every_row_once(spark):
    rows = [(None, None, "a"), (None, 2.0, None), (None, 4.0, "a"), (NAN, None, None), (NAN, 8.0, "b"), (1.0, 1.0, "c")]
    df = spark.createDataFrame(rows, "g double, v double, t string")
    fit = nils.fit_nils(df, {"v": "fill_median", "t": "fill_most_common"}, ["g"])
    got = sorted((str(named(r.g)), r.v, r.t) for r in nils.repair_nils(df, fit).collect())
    assert got == [
        ("1.0", 1.0, "c"), ("none", 2.0, "a"), ("none", 3.0, "a"), ("none", 4.0, "a"), ("odd", 8.0, "b"), ("odd", 8.0, "b"),
    ]


def test_mode_of_a_group_without_values_is_the_same_as_of_a_table(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("b", None)], "g string, v bigint")
    fit = nils.fit_nils(df, {"v": "fill_most_common"}, ["g"])
    assert sorted(tuple(r) for r in nils.repair_nils(df, fit).collect()) == [("a", "5"), ("a", "5"), ("b", "Unknown")]
    alone = df.filter("g = 'b'").drop("g")
    assert [r.v for r in nils.fill_most_common(alone, "v").collect()] == ["Unknown"]


@pytest.mark.parametrize("pairs", [1, 2, 20_000])
def test_large_groups_beyond_the_tracked_ones(spark, monkeypatch, pairs):
    monkeypatch.setattr(quantiles, "SMALL_GROUP_ROWS", 5)
    monkeypatch.setattr(quantiles, "TRACKED_PAIRS", pairs)
    made = np.random.default_rng(3)
    rows = [(g, float(x), None if x % 3 else float(x % 7)) for g in (None, NAN, 1.0, 2.0, 3.0) for x in made.integers(0, 40, 30)]
    rows += [(9.0, 1.0, 2.0), (9.0, 4.0, None)] + [(4.0, 7.0, None)] * 20
    df = spark.createDataFrame(rows, "g double, v double, w double")
    got = quantiles.grouped_quantiles(df, {"v": F.col("v"), "w": F.col("w")}, [0.0, 0.25, 0.5, 0.9, 1.0], ["g"])
    found = {(str(named(r.g)), r.column_name): r.q for r in got.collect()}
    assert len(found) == 14
    for (g, c), q in found.items():
        values = [r[1 if c == "v" else 2] for r in rows if str(named(r[0])) == g]
        values = [v for v in values if v is not None]
        assert (q is None) == (not values)
        if values:
            assert q == pytest.approx(list(np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0])))


def test_quantiles_of_a_table_that_changes_stop(spark, monkeypatch):
    monkeypatch.setattr(quantiles._Job, "resolve", lambda self, targets: None)
    with pytest.raises(RuntimeError):
        quantiles.table_quantiles(spark.range(10).selectExpr("double(id) as v"), {"v": F.col("v")}, [0.5])


def test_broadcasts_check_bytes_too(spark):
    wide = spark.range(30).select(F.repeat(F.lit("x"), 1 << 20).alias("t"))
    assert small_table(wide) is None and small_table(wide.limit(3)) is not None
    assert small_table(spark.range(30)) is not None
    assert columns.BROADCAST_BYTES == 16 << 20


def test_duplicates_of_binary_and_nested_values(spark):
    df = spark.range(6).select(
        F.repeat(F.lit("x"), 200).cast("binary").alias("b"), F.array(F.lit(1), F.lit(2)).alias("a"), (F.col("id") % 2).alias("k")
    )
    assert duplicate_rows(df).count() == 4


def test_padding_does_not_hide_a_date(spark):
    df = spark.createDataFrame([("2024-01-01" + " " * 200,), (" " * 200 + "Jan 5, 2024 10:30 PM",), ("x" * 300,)], "v string")
    assert [str(r[0]) for r in df.select(parsing.to_datetime("v")).collect()] == ["2024-01-01 00:00:00", "2024-01-05 22:30:00", "None"]


def test_integers_are_never_cut(spark):
    df = spark.createDataFrame([("12.7",), ("12.0",), ("9007199254740993",), ("1e3",), ("9e30",)], "v string")
    assert [r[0] for r in df.select(parsing.to_integer("v")).collect()] == [None, 12, 9007199254740993, 1000, None]


def test_csv_files_are_stacked_by_name(spark, tmp_path):
    texts = {"a": "id,price\n1,10\n", "b": "price,id\n20,2\n", "c": "id,price,more\n3,30,x\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    df = tables.read_sources(spark, [str(tmp_path / f"{n}.csv") for n in texts])
    got = sorted((r.source_file, r.id, r.price, r.more) for r in df.collect())
    assert got == [("a", "1", "10", None), ("b", "2", "20", None), ("c", "3", "30", "x")]


def test_files_without_quoted_breaks_are_split(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('a,b\n1,"say ""hi"""\n2,x\n')
    (tmp_path / "broken.csv").write_text('a,b\n1,"two\nlines"\n')
    found = csv_rows.layouts(spark, [str(tmp_path / "plain.csv"), str(tmp_path / "broken.csv")])
    assert [(f.file.rsplit("/", 1)[1], f.plain) for f in found] == [("broken.csv", False), ("plain.csv", True)]
    assert tables.read_text_table(spark, str(tmp_path / "broken.csv")).collect()[0].b == "two\nlines"


def test_snapshots_keep_columns_the_first_lacks(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "one.parquet"))
    spark.createDataFrame([(2, "x")], "a int, extra string").write.parquet(str(tmp_path / "two.parquet"))
    df = tables.read_snapshot_as_text(spark, [str(tmp_path / "one.parquet"), str(tmp_path / "two.parquet")])
    assert sorted((r.a, r.extra) for r in df.collect()) == [("1", None), ("2", "x")]


def test_integers_and_floats_stack_as_floats(spark):
    stacked = union_sources({"a": spark.createDataFrame([(1,)], "v bigint"), "b": spark.createDataFrame([(1.5,)], "v double")})
    assert sorted(r.v for r in stacked.collect()) == [1.0, 1.5]


@pytest.fixture
def frozen(spark):
    first = spark.createDataFrame([("1", "2024-01-01", "a"), ("2", "", "a"), ("", "2024-01-03", "b")], "n string, d string, t string")
    plan = CleaningPlan(
        {"n": ColumnDecision("integer"), "d": ColumnDecision("datetime"), "t": ColumnDecision("text")}, False,
        {"n": "fill_median", "d": "fill_zero", "t": "fill_most_common"},
    )
    return freeze(plan, clean_table(first, plan))


def test_frozen_replay_on_another_table(spark, frozen, tmp_path):
    save_plan(frozen, spark, str(tmp_path / "plan"))
    back = load_plan(spark, str(tmp_path / "plan"))
    second = spark.createDataFrame([("12.7", "", ""), ("7", "2024-02-01", "z"), ("", "x", "nan")], "n string, d string, t string")
    for plan in (frozen, back):
        out = apply_plan(second, plan, frozen=True)
        assert [tuple(r) for r in out.collect()] == [
            (1.5, "0", "a"), (7.0, "2024-02-01 00:00:00", "z"), (1.5, "0", "a"),
        ]


def test_plans_with_unfit_actions_are_refused(spark, text):
    df = text(v=["1", "2"], t=["x y", "z w"])
    with pytest.raises(ValueError):
        fit_plan(df.drop("n"), nil_actions={"t": "fill_median"}, corrections={"t": "text"})
    with pytest.raises(ValueError):
        clean_table(df, CleaningPlan({"t": ColumnDecision("text")}, False, {"t": "fill_median"}), ["n"])
    fit_plan(df.drop("n"), nil_actions={"t": "fill_unknown", "v": "fill_zero"}, corrections={"t": "text", "v": "integer"})


def test_many_levels_are_a_table_beside_the_plan(spark, tmp_path):
    df = spark.range(6000).selectExpr("concat('level', id % 1200) AS c", "string(id % 3) AS d", "if(id % 2 = 0, 'x', 'y') AS source_file")
    plan = fit_plan(df, corrections={"c": "categorical", "d": "categorical", "source_file": "text"})
    assert plan.levels == {"d": ["0", "1", "2"]} and plan.levels_of("nothing") is None
    save_plan(plan, spark, str(tmp_path / "p"))
    loaded = load_plan(spark, str(tmp_path / "p"))
    assert loaded.levels_of("d") == ["0", "1", "2"] and loaded.levels_of("c").count() == 1200
    later = df.filter("c IN ('level7', 'level8') OR c = 'unheard of'")
    long = crosstab_long(later, "c", levels=loaded.levels_of("c")).collect()
    assert len({r.category for r in long}) == 1200
    assert {(r.source_file, r.category): r["count"] for r in long if r["count"]} == {
        ("x", "level8"): 5, ("y", "level7"): 5,
    }
    wide = crosstab_counts(later, "c", levels=loaded.levels_of("c"))
    assert len(wide.columns) == 1201 and sum(r["level7"] + r["level9"] for r in wide.collect()) == 5


def test_levels_are_kept_in_the_plan(spark, tmp_path):
    df = spark.createDataFrame([(c,) for c in "bbca" * 50] + [("",)], "c string")
    plan = fit_plan(df)
    assert plan.levels == {"c": ["a", "b", "c"]}
    save_plan(plan, spark, str(tmp_path / "p"))
    assert load_plan(spark, str(tmp_path / "p")).levels == plan.levels


def test_every_file_has_its_own_log(spark):
    one = spark.createDataFrame([("1", "a"), ("1", "a"), ("", "b")], "v string, w string")
    two = spark.createDataFrame([("2", ""), ("3", "c"), ("3", "c"), ("3", "c")], "v string, w string")
    plan = CleaningPlan({"v": ColumnDecision("integer"), "w": ColumnDecision("text")}, True, {"v": "fill_median", "w": "fill_unknown"})
    together, _, log = clean_many({"one": one, "two": two}, plan)
    alone, _, other = clean_many({"one": one, "two": two.withColumn("x", F.lit("y"))}, plan)
    assert [e for e in log.entries] == [e for e in other.entries if "'x'" not in e[1]]
    assert (1, "Dropped 1 duplicate rows") in log.entries and (2, "Dropped 2 duplicate rows") in log.entries
    assert (1, "Filled 1 nil values in 'v' with median (1.0)") in log.entries
    assert (2, "No nil values in 'v'") in log.entries
    assert sorted(together.collect()) == sorted(alone.select(together.columns).collect())


def test_unplanned_columns_are_inferred_file_by_file(spark):
    files = {
        "one": spark.createDataFrame([(" 5.0",), ("6",)], "u string"),
        "two": spark.createDataFrame([("abc",), ("def",)], "u string"),
    }
    done, _, log = clean_many(files, CleaningPlan({}, False))
    assert sorted((r.source_file, r.u) for r in done.collect()) == [("one", "5"), ("one", "6"), ("two", "abc"), ("two", "def")]
    assert (1, "Converted 'u' to integer") in log.entries


def test_intermediate_tables_are_deleted(spark, text, tmp_path):
    import os

    plan = CleaningPlan({"v": ColumnDecision("integer")}, True, {"v": "fill_median"})
    done = clean_table(text(v=["1", "", "3"]), plan, ["n"])
    paths = list(done.scratch)
    assert paths and all(os.path.isdir(p) for p in paths)
    done.close()
    assert not any(os.path.exists(p) for p in paths)
    rows, path = materialize(spark.range(3).toDF("a"), "x")
    assert rows.count() == 3 and os.path.isdir(path)


def test_approximate_forms_are_close(spark):
    df = spark.range(20_000).selectExpr("double(id) as v", "cast(id % 5000 as string) as t", "id % 2 as g")
    counts = {r.column_name: r.unique_count for r in statistics.count_distinct(df, approx=True).collect()}
    assert counts["v"] == pytest.approx(20_000, rel=0.05) and counts["t"] == pytest.approx(5000, rel=0.05)
    (q,) = statistics.quartiles_iqr(df, ["v"], approx=True).collect()
    assert (q.q1, q.q3) == (pytest.approx(5000, abs=60), pytest.approx(15_000, abs=60))
    assert statistics.quartiles_iqr(df, ["v"], ["g"], approx=True).count() == 2


def test_moments_within_nested_values_keep_their_fraction(spark):
    from mendtable.sources.json_text import rows_as_json

    at = "timestamp'2024-01-02 03:04:05.000600'"
    df = spark.range(1).selectExpr(
        f"{at} as t", f"array({at}, null) as a", f"named_struct('x', {at}, 'y', double('NaN')) as s",
        f"map('k', {at}) as m", "cast(null as struct<x:timestamp>) as n",
    )
    moment = "2024-01-02T03:04:05.000600"
    assert rows_as_json(df).first()[0] == (
        f'{{"t":"{moment}","a":["{moment}",null],"s":{{"x":"{moment}","y":null}},"m":{{"k":"{moment}"}},"n":null}}'
    )


def test_empty_tables_are_cleaned(spark):
    empty = spark.createDataFrame([], "v string, w string")
    actions = {"v": "fill_median", "w": "fill_most_common"}
    plan = CleaningPlan({"v": ColumnDecision("integer"), "w": ColumnDecision("text")}, True, actions)
    done = clean_table(empty, plan)
    assert done.table.collect() == [] and (1, "No duplicate rows found") in done.log.entries
    one = spark.createDataFrame([("1", "x")], "v string, w string")
    for files, want in (({"a": empty, "b": one}, [(1, "x", "b")]), ({"a": empty, "b": empty}, [])):
        together, _, log = clean_many(files, plan)
        assert [tuple(r) for r in together.select("v", "w", "source_file").collect()] == want
        assert {n for n, _ in log.entries} == {1, 2} and dict(together.dtypes)["v"] == "bigint"
    together, _, _ = clean_many({"a": one.filter("v = '9'"), "b": empty}, CleaningPlan({}, True))
    assert together.collect() == []


@pytest.mark.parametrize("by", [(), ("l_returnflag",)])
def test_approximate_statistics(spark, sf_dir, by):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_returnflag", "l_linestatus", "if(l_linenumber = 1, null, l_quantity) AS q", "l_partkey", "if(l_orderkey % 50 = 0, l_tax + 9, l_tax) AS tax",
        "CAST(null AS double) AS nothing",
    )
    exact = {(*[r[b] for b in by], r.column_name): r for r in statistics.column_statistics(lines, by).collect()}
    found = statistics.column_statistics(lines, by, approx=True)
    got = {(*[r[b] for b in by], r.column_name): r for r in found.collect()}
    assert set(got) == set(exact) and found.columns == statistics.column_statistics(lines, by).columns
    for key, r in got.items():
        e = exact[key]
        for same in ("column_index", "dtype", "non_null_count", "null_count", "min", "max"):
            assert r[same] == e[same]
        assert abs(r.unique_count - e.unique_count) <= 0.05 * e.unique_count
        assert (r.has_outliers, r.outlier_count is None) == (e.has_outliers, e.outlier_count is None)
        for near in ("mean", "std", "median"):
            assert (r[near] is None) == (e[near] is None) and (r[near] is None or r[near] == pytest.approx(e[near], rel=0.05, abs=1e-9))
    assert statistics.column_statistics(lines.select("l_linestatus"), approx=True).collect()[0].unique_count == 2
