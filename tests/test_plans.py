"""Plans: decide, save, replay; many tables; reports and charts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from mendtable.operators import charts
from mendtable.operators.selection import (
    all_column_names, project_required, required_columns, stack_by_name, union_sources,
)
from mendtable.operators.summaries import crosstab_counts, crosstab_long
from mendtable.plans.pipeline import apply_plan, clean_many, clean_table, freeze
from mendtable.plans.plan import CleaningPlan, ColumnDecision, fit_plan, load_plan, save_plan
from mendtable.plans.report import analysis_report, default_task, run_summary
from mendtable.sources import tables
from mendtable.sources.logs import ProcessingLog, append_log, log_head
from mendtable.sources.snapshots import read_snapshot
from mendtable.sources.workspace import scratch_path, shared_folder


def test_targets():
    assert ColumnDecision("integer", True).target == "integer"
    assert ColumnDecision("integer", False).target is None
    assert ColumnDecision("integer", False, "float").target == "float"
    assert ColumnDecision("integer", True, "skip").target is None


def test_plan_survives_saving(spark, tmp_path):
    plan = CleaningPlan(
        {"a": ColumnDecision("integer", True), "b c": ColumnDecision("currency", False, "currency")},
        True, {"a": "fill_median"}, ["x"], ["a"], {"a": "1.5"},
    )
    path = str(tmp_path / "plan")
    save_plan(plan, spark, path)
    back = load_plan(spark, path)
    assert back.preloaded
    back.preloaded = False
    assert back == plan


def test_plan_of_an_earlier_tool_can_be_loaded(spark, tmp_path):
    path = tmp_path / "cleaning_decisions.json"
    path.write_text(
        json.dumps(
            {
                "stored_column_decisions": {"price": {"type": "float", "approved": True, "correction": None}},
                "stored_duplicate_decision": None,
                "stored_nil_decisions": {"price": "fill_zero"},
                "stored_columns_to_drop": [],
            },
            indent=2,
        )
    )
    plan = load_plan(spark, str(path))
    assert plan.columns["price"].target == "float" and plan.drop_duplicates is None
    assert plan.nil_actions == {"price": "fill_zero"}


def test_no_plan_file(spark, tmp_path):
    assert load_plan(spark, str(tmp_path / "none.json")) is None


def listings(spark, city, shift):
    rows = [
        (f"{i:06}", f'Flat "{i}",\nwith view', "" if i % 5 == 0 else f"host {i}", f"area {i % 3}", "Entire home",
         "" if i % 7 == 0 else f"${1 + i % 3},{i % 900 + 100}.50", str((i + shift) % 365))
        for i in range(1, 101)
    ]
    rows += rows[:10]
    names = "id name host_name neighbourhood room_type price availability_365".split()
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


@pytest.fixture
def city_files(spark, tmp_path):
    paths = []
    for shift, city in enumerate(["Athens", "Barcelona"]):
        folder = tmp_path / city
        folder.mkdir()
        pdf = listings(spark, city, shift).toPandas()
        pdf.to_csv(folder / "listings.csv", index=False)
        paths.append(str(folder / "listings.csv"))
    return paths


def test_csv_files_to_cleaned_cities(spark, city_files):
    raw = tables.read_sources(spark, city_files, stage=True)
    assert raw.count() == 220
    assert {r[0] for r in raw.select("source_file").distinct().collect()} == {"Athens", "Barcelona"}
    assert raw.filter(F.col("name").contains("\n")).count() == 220
    assert raw.filter("host_name = ''").count() > 0 and raw.filter("host_name is null").count() == 0

    cities = {c: raw.filter(F.col("source_file") == c).drop("file_path", "source_file") for c in ("Athens", "Barcelona")}
    done, plan, log = clean_many(
        cities,
        corrections={"price": "currency"},
        nil_actions={"price": "fill_median", "host_name": "fill_unknown"},
        columns_to_drop=["room_type"],
        approve_all=True,
    )
    types = {c: d.target for c, d in plan.columns.items()}
    # ten of 110 rows are copies, so the id is not unique enough to be an identifier
    assert types == {
        "id": "integer", "name": "text", "host_name": "text", "neighbourhood": "categorical",
        "room_type": "categorical", "price": "currency", "availability_365": "integer",
    }
    assert done.count() == 200
    assert "room_type" not in done.columns
    assert done.filter("price is null").count() == 0 and done.filter("host_name = 'Unknown'").count() == 40
    assert dict(done.dtypes)["availability_365"] == "bigint"

    report = analysis_report(done, ["price", "availability_365"], "neighbourhood", order_by=["id"])
    records = {r.source_file: r.records for r in report["entity_stats"].collect()}
    assert records == {"Athens": 100, "Barcelona": 100}
    assert report["sample"].count() == 20
    assert report["total_records"].first()[0] == 200
    wide = report["breakdown"].orderBy("source_file").collect()
    assert [sum(r[1:]) for r in wide] == [100, 100]


def test_source_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_text_table(spark, str(tmp_path / "none.csv"))
    odd = tmp_path / "x.xlsx"
    odd.write_text("a")
    with pytest.raises(ValueError):
        tables.read_text_table(spark, str(odd))
    assert tables.existing_paths(spark, [str(odd), str(tmp_path / "none.csv")]) == [str(odd)]


def test_csv_words_stay_text(spark, tmp_path):
    f = tmp_path / "t.csv"
    f.write_text('a,b,c\nNA, x ,""\nnull,"say ""hi""",1\n')
    got = tables.read_text_table(spark, str(f)).collect()
    assert [tuple(r) for r in got] == [("NA", " x ", ""), ("null", 'say "hi"', "1")]


def test_snapshots(spark, tmp_path, sf_dir):
    messy = fx.messy_orders(spark, sf_dir)
    plan = fit_plan(messy, ["o_orderkey"], corrections={"price": "currency"}, nil_actions={"amount": "fill_median"})
    done = clean_table(messy, plan, ["o_orderkey"], snapshots=str(tmp_path), label="orders")
    assert read_snapshot(spark, str(tmp_path / "orders_transformed")).count() == messy.count()
    kept = read_snapshot(spark, str(tmp_path / "orders_cleaned"))
    assert sorted(kept.collect(), key=repr) == sorted(done.table.collect(), key=repr)
    text = tables.read_text_table(spark, str(tmp_path / "orders_cleaned"), fmt="parquet")
    assert {t for _, t in text.dtypes} == {"string"} and text.filter("amount is null").count() == 0


def test_cleaning_a_cleaned_table_changes_nothing(spark, sf_dir):
    messy = fx.messy_orders(spark, sf_dir)
    actions = {"amount": "fill_median", "status": "fill_unknown", "priority": "drop_rows"}
    plan = fit_plan(messy, ["o_orderkey"], corrections={"price": "currency"}, nil_actions=actions)
    once = apply_plan(messy, plan, order_by=["o_orderkey"])
    twice = apply_plan(tables.as_text(once), plan)
    assert sorted(tables.as_text(once).collect()) == sorted(tables.as_text(twice).collect())


def test_frozen_plan_reuses_the_first_tables_values(spark, text):
    first, second = text(v=["1", "3", ""]), text(v=["10", "", "30"])
    plan = CleaningPlan({"v": ColumnDecision("integer")}, False, {"v": "fill_median"})
    frozen = freeze(plan, clean_table(first, plan, ["n"]))
    assert sorted(r.v for r in apply_plan(second, plan, order_by=["n"]).collect()) == [10, 20, 30]
    assert sorted(r.v for r in apply_plan(second, frozen, order_by=["n"], frozen=True).collect()) == [2, 10, 30]


def test_columns_the_plan_does_not_know_are_inferred(text):
    df = text(v=["1", "2"], extra=["2024-01-01", "2024-01-02"])
    plan = CleaningPlan({"v": ColumnDecision("text")})
    out = apply_plan(df, plan, order_by=["n"])
    assert dict(out.dtypes) == {"v": "string", "extra": "timestamp"}


def test_stacked_tables_that_disagree_on_integers_become_text(spark):
    one = spark.createDataFrame([("1.0",), ("x",)], "v string")
    two = spark.createDataFrame([("2.5",), ("3",)], "v string")
    plan = CleaningPlan({"v": ColumnDecision("integer")}, False)
    done, _, _ = clean_many({"one": one, "two": two}, plan)
    got = sorted((r.source_file, r.v) for r in done.collect() if r.v is not None)
    assert got == [("one", "1"), ("two", "2.5"), ("two", "3")]


def test_tables_with_different_columns(spark):
    one = spark.createDataFrame([("1", "a")], "v string, w string")
    two = spark.createDataFrame([("2",)], "v string")
    plan = CleaningPlan({"v": ColumnDecision("integer"), "w": ColumnDecision("text")}, True)
    done, _, log = clean_many({"one": one, "two": two}, plan)
    assert sorted(tuple(r) for r in done.select("source_file", "v", "w").collect()) == [("one", 1, "a"), ("two", 2, None)]
    assert {n for n, _ in log.entries} == {1, 2}


def test_clashing_types_stack_as_text(spark):
    stacked = union_sources({"a": spark.createDataFrame([(1,)], "v int"), "b": spark.createDataFrame([("x",)], "v string")})
    assert sorted(r.v for r in stacked.collect()) == ["1", "x"]
    assert all_column_names([stacked, spark.range(1)]) == ["v", "source_file", "id"]


def test_required_columns():
    names = ["source_file", *"abcdefghij"]
    assert required_columns(names, ["b", "zz", "a", "b"], "c") == ["source_file", "b", "a", "c"]
    assert required_columns(names, ["zz"]) == ["source_file", *"abcdefgh"]
    assert required_columns(names, ["zz"], "j") == ["source_file", "j"]


def test_default_task():
    assert default_task(["source_file", *"abcdefg"]).required_columns == tuple("abcde")


def test_project_required_keeps_order(spark):
    df = spark.createDataFrame([("s", 1, 2)], "source_file string, a int, b int")
    assert project_required(df, ["b", "a"]).columns == ["source_file", "b", "a"]


def test_crosstab_keeps_sources_without_a_top_category(spark):
    rows = [("one", f"c{i}") for i in range(20) for _ in range(20 - i)] + [("two", "c19"), ("three", None)]
    df = spark.createDataFrame(rows, "source_file string, g string")
    wide = crosstab_counts(df, "g")
    assert len(wide.columns) == 16
    got = {r.source_file: sum(r[1:]) for r in wide.collect()}
    assert got == {"one": sum(20 - i for i in range(15)), "two": 0}
    assert crosstab_long(df, "g").count() == 30


def test_crosstab_total_is_rows_with_a_category(spark, sf_dir):
    docs = fx.stacked_documents(spark, sf_dir)
    total = sum(sum(r[1:]) for r in crosstab_counts(docs, "lang").collect())
    assert total == docs.filter("lang is not null").count()
    levels = crosstab_counts(docs, "lang", levels=["en", "xx"])
    assert levels.columns == ["source_file", "en", "xx"]


def test_charts_fall_back(spark):
    stats = spark.createDataFrame([("a", 5, 1.0, 2.0), ("b", 15, 3.0, 2.0)], "source_file string, records long, m double, k double")
    bar = charts.chart_bar(stats, "nothing").collect()
    assert {r.metric for r in bar} == {"m"}
    scatter = {r.source_file: r["size"] for r in charts.chart_scatter(stats).collect()}
    assert scatter["b"] == 1000.0
    pie = {r.source_file: r.percent for r in charts.chart_pie(stats).collect()}
    assert pie == {"a": 25.0, "b": 75.0}
    heat = {(r.metric, r.source_file): r.normalized for r in charts.chart_heatmap(stats).collect()}
    assert heat[("m", "a")] == 0.0 and heat[("m", "b")] == pytest.approx(1.0) and heat[("k", "a")] == 0.0
    with pytest.raises(ValueError):
        charts.chart_data("radar", stats)


def test_chart_rules():
    assert charts.check_chart("pie", 9) and not charts.check_chart("bar", 9)
    assert charts.check_chart("grouped_bar", 2, 7) and not charts.check_chart("grouped_bar", 2, 6)


def test_box_matches_the_usual_definition(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([("s", v) for v in values], "source_file string, v double")
    (r,) = charts.chart_box(df, "v").collect()
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.flier_count, r.n) == (2, 3, 4, 1, 4, 1, 5)
    assert [r.value for r in charts.chart_box_fliers(df, "v").collect()] == [100.0]


def test_log(spark, tmp_path):
    log = ProcessingLog()
    for i in range(10):
        log.add(1, f"step {i}")
    path = str(tmp_path / "log")
    append_log(log.to_df(spark), path)
    append_log(log.to_df(spark), path)
    assert spark.read.json(path).count() == 20
    head = log_head(log.to_df(spark)).collect()
    assert [r.message for r in head] == [f"[File 1] step {i}" for i in range(8)]
    assert {r.more for r in head} == {2}
    df = spark.createDataFrame([("a",), ("a",)], "source_file string")
    assert run_summary(df, log.to_df(spark))["log_entries"].first()[0] == 10


class FakeSession:
    """Just what the folder lookup reads of a session."""

    def __init__(self, named, made, master):
        settings = {"spark.checkpoint.dir": named}
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: settings[key] or default)})
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": staticmethod(lambda: made)})


def test_shared_folder_follows_the_session():
    assert shared_folder(FakeSession("/shared/folder/", None, "yarn")) == "/shared/folder"
    assert shared_folder(FakeSession(None, "/set/in/code", "yarn")) == "/set/in/code"
    with pytest.raises(ValueError):
        shared_folder(FakeSession(None, None, "yarn"))
    local = shared_folder(FakeSession(None, None, "local[2]"))
    assert os.path.isdir(local) and shared_folder(FakeSession(None, None, "local")) == local
    assert scratch_path(FakeSession("/shared", None, "yarn"), "x").startswith("/shared/x-")
    with pytest.raises(ValueError):
        scratch_path(FakeSession(None, None, "yarn"), "x")


def _layout_tables(spark, alike=False):
    """Four tables of one kind: all columns; fewer; fewer still; in another order."""

    def made(k, columns):
        rows = spark.range(50).selectExpr(
            f"string(id + {k}) AS a", "if(id % 7 = 0, '', string(id * 2)) AS b",
            "if(id % 5 = 0, 'nan', concat('x', id % 3)) AS c", f"if(id % 9 = 0, '', string(id / {4 if k < 3 else 1})) AS d",
        )
        return rows.unionAll(rows.filter(f"int(a) < {2 * k}")).select(*columns)

    layouts = [["a", "b", "c", "d"], ["a", "b", "c"], ["a", "b"], ["d", "a"]]
    return {f"t{k}": made(k, layouts[0] if alike else columns) for k, columns in enumerate(layouts)}


def _jobs(spark, call):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("layouts", "")
    before = len(tracker.getJobIdsForGroup("layouts"))
    out = call()
    n = len(tracker.getJobIdsForGroup("layouts")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, n


LAYOUT_PLAN = CleaningPlan(
    {"a": ColumnDecision("integer"), "b": ColumnDecision("integer"), "c": ColumnDecision("categorical"), "d": ColumnDecision("float")},
    True, {"b": "fill_median", "c": "fill_most_common", "d": "drop_rows"}, ["a"],
)


@pytest.mark.parametrize("planned", ["abcd", "ad"])
def test_many_layouts_come_out_as_if_alone(spark, planned):
    plan = CleaningPlan(
        {c: d for c, d in LAYOUT_PLAN.columns.items() if c in planned}, True,
        {c: x for c, x in LAYOUT_PLAN.nil_actions.items() if c in planned}, ["a"],
    )
    tables_ = _layout_tables(spark)
    together, _, log = clean_many(tables_, plan)
    alone = [clean_many({label: t}, plan) for label, t in tables_.items()]
    want = stack_by_name([a[0] for a in alone]).select(*together.columns)
    assert together.dtypes == want.dtypes
    assert sorted(map(str, together.collect())) == sorted(map(str, want.collect()))
    said = [(i, e[1]) for i, a in enumerate(alone, 1) for e in a[2].entries]
    assert [(e[0], e[1]) for e in log.entries] == said


def test_many_layouts_take_no_more_jobs_than_one(spark):
    _, several = _jobs(spark, lambda: clean_many(_layout_tables(spark), LAYOUT_PLAN))
    _, one = _jobs(spark, lambda: clean_many(_layout_tables(spark, alike=True), LAYOUT_PLAN))
    assert several <= one <= 24
