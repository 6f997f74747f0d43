"""Physical plans: what is pushed down, shuffled and broadcast."""

import re

import pytest
from physical import physical_plan
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import fixtures as fx
from checks.fixtures import table
from mendtable.operators.duplicates import duplicate_count
from mendtable.operators.frequencies import value_frequencies
from mendtable.operators.infer import infer_types
from mendtable.operators.selection import head_per_source
from mendtable.operators.statistics import column_statistics, iqr_outlier_rows
from mendtable.operators.summaries import source_summary
from mendtable.plans.pipeline import clean_table
from mendtable.plans.plan import CleaningPlan, ColumnDecision
from mendtable.plans.report import analysis_report
from mendtable.sources.tables import read_text_table

HEAVY = ["infer_types", "column_statistics", "clean_many", "repair_nils_by_group", "chart_box", "describe_by_source"]


@pytest.mark.parametrize("name", HEAVY)
def test_no_python_in_plans(spark, sf_dir, name):
    plan = physical_plan(contract.queries()[name](spark, sf_dir))
    assert not re.search(r"Python|Arrow|Pandas|FlatMapGroups", plan)


@pytest.mark.parametrize("name", HEAVY)
def test_no_cross_joins(spark, sf_dir, name):
    plan = physical_plan(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_outlier_filter_reaches_the_scan(spark, sf_dir):
    plan = physical_plan(iqr_outlier_rows(table(spark, sf_dir, "events").select("event_id", "value"), "value"))
    assert re.search(r"PushedFilters: \[.*(LessThan\(value|GreaterThan\(value).*\]", plan)
    assert re.search(r"ReadSchema: struct<event_id:bigint,value:double>", plan)
    assert "Exchange" not in plan


def test_frequencies_count_before_the_shuffle(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount")
    plan = physical_plan(value_frequencies(df))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert tree.index("Exchange") < tree.rindex("HashAggregate") and "partial_count" in plan


def test_duplicate_count_shuffles_digests_of_long_text(spark, sf_dir):
    plan = physical_plan(duplicate_count(table(spark, sf_dir, "documents").select("text")))
    assert "sha2" in plan


def test_source_summary_is_one_combined_aggregate(spark, sf_dir):
    plan = physical_plan(source_summary(fx.stacked_lineitem(spark, sf_dir).select("source_file", "l_quantity")))
    assert plan.split("\n\n")[0].count("Exchange") == 1
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_heads_are_cut_before_the_shuffle(spark, sf_dir):
    plan = physical_plan(head_per_source(fx.stacked_documents(spark, sf_dir), ["doc_id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_inference_samples_are_cut_before_the_shuffle(spark, sf_dir):
    messy = fx.messy_orders(spark, sf_dir).select("o_orderkey", "status", "priority")
    plan = physical_plan(infer_types(messy, order_by=["o_orderkey"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_inference_reads_a_file_twice_at_most(spark, tmp_path):
    path = str(tmp_path / "seven.csv")
    spark.range(50).selectExpr(*[f"cast(id + {j} as string) as c{j}" for j in range(7)]).write.csv(path, header=True)
    plan = physical_plan(infer_types(read_text_table(spark, path)))
    assert plan.split("\n\n")[0].count("Scan csv") <= 2


def jobs_of(spark, call):
    """How many jobs a call starts."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    before = len(tracker.getJobIdsForGroup("counted"))
    try:
        out = call()
        return out, len(tracker.getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_few_jobs_at_call(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_tax", "l_returnflag")
    _, n = jobs_of(spark, lambda: column_statistics(lines))
    assert n <= 6
    typed = lines.selectExpr("cast(l_quantity as string) as q", "l_returnflag as f", "cast(l_tax as string) as t")
    plan = CleaningPlan(
        {"q": ColumnDecision("float"), "f": ColumnDecision("categorical"), "t": ColumnDecision("float")}, True,
        {"q": "fill_median", "t": "fill_zero", "f": "fill_unknown"},
    )
    _, n = jobs_of(spark, lambda: clean_table(typed, plan))
    assert n <= 8


def test_a_report_runs_nothing_until_a_part_is_asked_for(spark, sf_dir):
    docs = fx.stacked_documents(spark, sf_dir)
    report, n = jobs_of(spark, lambda: analysis_report(docs, ["n_chars"], "source", order_by=["doc_id"]))
    assert n == 0 and set(report) == {"describe", "entity_stats", "total_records", "sample", "breakdown", "breakdown_long"}
    total, n = jobs_of(spark, lambda: report["total_records"])
    assert n == 0 and report["total_records"] is total


def test_a_hot_source_does_not_change_the_answer(spark):
    """A third of all rows in one source, one value and one row: grouped results stay whole."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source_file"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("v"),
    )
    got = {r.source_file: r.row_count for r in source_summary(df).collect()}
    assert got["hot"] == 3000 and sum(got.values()) == 9000
