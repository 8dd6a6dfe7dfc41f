"""Plan shapes that must hold at scale."""

import re

import pytest

from __spark_entry__ import queries
from cyclemart.operators import daily
from cyclemart.operators.goals import goals_by_day
from cyclemart.plans import loads
from cyclemart.plans.registry import CYCLE_END, CYCLE_START
from cyclemart.session import tune
from cyclemart.sources.retail import RetailSource

FOLDER = "/root/testdata/sf0.001"
LAZY = ("sales_daily", "movements_daily", "goals_by_day", "fact_daily", "rankings_all", "repurchase_gap", "brand_profile",
        "kpi_derived", "kpi_company", "commission_tiers", "chart_daily", "rank_multi_branch", "quality_report", "policy_rows")


@pytest.fixture
def no_broadcast(spark):
    """Tables as they are at scale: nothing is small enough to broadcast."""
    tune(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, plan, name, no_broadcast):
    text = plan(queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_filters_and_columns_reach_the_scans(spark, plan):
    text = plan(queries()["rank_customers"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[[^]]*Not\(EqualTo\(l_returnflag,R\)\)", text)
    assert re.search(r"PushedFilters: \[[^]]*Not\(EqualTo\(o_orderstatus,P\)\)", text)
    lineitem = re.search(r"ReadSchema: struct<(l_[^>]*)>", text).group(1)
    assert "l_quantity" not in lineitem and "l_shipdate" not in lineitem and "l_partkey" not in lineitem


def test_a_period_reaches_the_scans(spark, plan):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(loads.build_fact(RetailSource(spark, FOLDER), (CYCLE_START, CYCLE_END)))
    assert [len(re.findall(rf"PushedFilters: \[[^]]*GreaterThanOrEqual\({c},1998-02-26", text)) for c in ("o_orderdate", "l_shipdate")] == [1, 1]
    # Sales and cancellations share a scan of the items; returns are dated on the item and need their own.
    scans = re.findall(r"FileScan parquet \[([lo]_\w*key)", text)
    assert (scans.count("l_orderkey"), scans.count("o_orderkey")) == (2, 2)


def test_chosen_cycles_prune_months_while_the_query_runs(spark, plan):
    text = plan(queries()["kpi_two_cycles"](spark, FOLDER))
    fact_scans = re.findall(r"FileScan parquet [^\n]*id_empresa[^\n]*PartitionFilters: \[([^]]*)\]", text)
    assert any("dynamicpruning" in f and "ano_mes" in f for f in fact_scans), fact_scans


def test_lists_are_cut_before_their_shuffle(spark, plan):
    for name in ("rankings_all", "brand_profile", "top5_sellers"):
        text = plan(queries()[name](spark, FOLDER))
        assert re.search(r"WindowGroupLimit [^\n]*Partial", text), name


def test_actuals_shuffle_once_after_the_item_join(spark, plan, no_broadcast):
    """Ticket counts need no shuffle of their own: lines are already partitioned by document."""
    text = plan(daily.daily_actuals(RetailSource(spark, FOLDER).movements()))
    above_join = text[:text.index("SortMergeJoin")]
    assert above_join.count("Exchange") == 1 and "Exchange hashpartitioning(data_ref" in above_join


def test_goal_days_are_not_shuffled(spark, plan):
    src = RetailSource(spark, FOLDER)
    text = plan(goals_by_day(src.goal_sellers(), src.goal_cycles(), src.sellers(), src.rules))
    assert "Exchange" not in text[:text.index("BroadcastHashJoin")] and "hashpartitioning(data_ref" not in text


def test_fact_spreads_rates_without_a_further_shuffle(spark, plan):
    text = plan(queries()["fact_daily"](spark, FOLDER))
    above_union = text[:text.index("Union")]
    assert above_union.count("Exchange") == 1 and "Window" in above_union


def test_ranked_customers_cut_the_orders_before_the_item_join(spark, plan, no_broadcast):
    text = plan(queries()["repurchase_gap"](spark, FOLDER))
    item_join = text.index("SortMergeJoin [nunota")
    assert "LeftSemi" in text[item_join:]
