"""Plans of the registered queries: no cross join, no Python in the executors, no
unexpected single task."""

import os
import re

import pytest

from dealglass.catalog.queries import ANALYTICS, HISTORY, PRIMITIVES, all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# Windows without a partition key, each over rows already grouped by month, stage,
# deal source, rep or part of a ranking.
GROUPED_WINDOWS = {
    "cohort_table_thirds", "customer_tiles",
    "monthly_revenue_summary", "mrr_trend", "funnel_velocity", "cohort_analysis",
    "rep_leaderboard", "window_lag_global", "window_running_sum", "window_share", "window_rank",
}


def plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


PAST = [name for name in HISTORY if name.startswith(("deal_stage_age", "audit_replay"))]


@pytest.mark.parametrize("name", [*ANALYTICS, *PRIMITIVES, *PAST])
def test_shape(spark, capsys, name):
    text = plan(all_queries()[name](spark, FOLDER), capsys)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search("BatchEvalPython|ArrowEvalPython|InPandas|InArrow", text)
    if re.search(r"\bWindow \[", text) and "SinglePartition" in text:
        assert name in GROUPED_WINDOWS
        window = text.index("Window [")
        assert "HashAggregate" in text[window:]          # below the window: grouped rows


def test_filters_and_columns_reach_the_scan(spark, capsys):
    text = plan(all_queries()["monthly_revenue_summary"](spark, FOLDER), capsys)
    assert "EqualTo(o_orderstatus,F)" in text
    one = all_queries()["filter_active"](spark, FOLDER)
    scan = re.search(r"ReadSchema: struct<([^>\n]*)", plan(one, capsys)).group(1)
    assert {c.split(":")[0] for c in scan.split(",")} == {
        "o_orderkey", "o_orderstatus", "o_totalprice"}


def test_stages_are_broadcast_not_shuffled(spark, capsys):
    text = plan(all_queries()["agg_weighted"](spark, FOLDER), capsys)
    assert "BroadcastHashJoin" in text and "hashpartitioning(stage_id" not in text


@pytest.mark.parametrize("name", [*ANALYTICS, *PRIMITIVES])
def test_shape_without_broadcasts(spark, capsys, name):
    """Tables beyond any broadcast still meet by keys, and no fact is read for a place."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(all_queries()[name](spark, "/root/testdata/sf0.1"), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BroadcastExchange", text)


def test_place_joins_go_where_no_place_is_wanted(spark, capsys):
    for name in ("join_inner", "win_loss", "deal_risk_scores", "pipeline_scoring"):
        assert "nation.parquet" not in plan(all_queries()[name](spark, FOLDER), capsys)


def test_large_facts_are_read_once(spark, capsys):
    for name in ("upsell_opportunities", "owned_products"):
        text = plan(all_queries()[name](spark, FOLDER), capsys)
        assert text.count("lineitem.parquet") == 1
    assert plan(all_queries()["dq_orphans"](spark, FOLDER), capsys).count("lineitem.parquet") == 2
