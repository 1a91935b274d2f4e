"""Shape of the physical plans, with broadcasts switched off as on tables too large for them."""

from __future__ import annotations

import re

import pytest

from catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Results of one row, or of a fixed number of rows, end in one task; so does a final top-n.
SMALL = {
    "p03_join_fanout_audit", "p16_dimension_scores", "p17_rejections_by_rule", "p18_format_corrections",
    "p19_load_report", "p09_quality_controls", "p09_quality_controls_defects", "p20_validate_billing",
    "p21_filter_portfolio", "p47_assigned_portfolio", "p23_monthly_series", "p23_monthly_series_filtered",
    "p25_compare_periods", "p26_streaks", "p35_case_mix", "p36_kpi_cards", "p36_kpi_cards_near_targets",
    "p37_support_metrics", "p38_key_message_facts", "p39_trend_12m", "p40_top_clients", "p07_priority_top",
    "j07_cardinality", "s04_source_row", "p45_filter_facets",
}


@pytest.fixture(scope="module")
def plans(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {
        name: job(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for name, job in QUERIES.items()
        if name not in {
            "p10_write_audit_publish", "p11_control_history", "p20_validate_billing", "t01_billing_arrivals"}
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_cross_joins_or_nested_loops(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_no_python_in_the_plans(plans):
    for name, plan in plans.items():
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", plan), name


def test_large_results_do_not_pass_through_one_task(plans):
    for name, plan in plans.items():
        if name not in SMALL:
            assert "SinglePartition" not in plan, name


def test_ranks_do_not_partition_by_the_ranked_group(plans):
    for name in ("p01_client_risk_cost", "p02_client_risk_cost_legacy", "p05_priority_score", "w04_percent_rank"):
        assert not re.search(r"hashpartitioning\(clase_riesgo#\d+, \d+\)", plans[name]), name
        assert "Window" not in plans[name], name


def test_one_shuffle_per_source(plans):
    """Facts meet the clients on the shuffle of their own aggregation."""
    by_client = re.findall(r"Exchange hashpartitioning\(id_cliente#\d+, \d+\)", plans["p04_priority_metrics"])
    assert len(by_client) == 4
    assert len(re.findall(r"Exchange hashpartitioning\(id_cliente#\d+, periodo#\d+", plans["p24_client_series"])) == 1
    assert "SortMergeJoin [id_cliente" not in plans["p24_client_series"]


def test_dates_reach_the_scan(plans):
    for name in ("p08_daily_snapshot", "p23_monthly_series", "p29_rate_vs_target", "p42_client_month_cases"):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\((o_orderdate|l_shipdate)", plans[name]), name


def test_scans_read_only_what_is_used(plans):
    assert "ReadSchema: struct<o_orderkey:bigint>" in plans["p09_quality_controls"]
    assert "l_extendedprice" not in plans["p08_daily_snapshot"]


def test_latest_and_last_rows_are_reduced_before_the_shuffle(plans):
    assert "partial_max_by" in plans["p08_daily_snapshot"]
    assert "WindowGroupLimit" in plans["p43_last_preventions"]


def test_text_is_read_once_per_pass(plans):
    """No copy of the text readers in pushed filters or join conditions."""
    plan = plans["p14_split_valid"]
    for line in plan.splitlines():
        if re.match(r"[\s:+\-*()\d]*(Filter|\w*Join)\b", line):
            assert "regexp" not in line.lower() and "rlike" not in line.lower()
