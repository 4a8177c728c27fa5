"""Shapes of physical plans: what must be there at scale, and what must not."""

import contextlib
import io

import pytest

from marketlake.plans import catalog

# Queries that write as they are called; their results are plain table scans.
EAGER = {
    "fact_load_day", "append_staging", "ctas_details", "daily_batch", "csv_daily_roundtrip",
    "csv_history_roundtrip", "csv_details_roundtrip", "union_bars", "stream_current_day",
    "stream_current_day_metrics", "init_metrics_table",
}
LAZY = sorted(set(catalog.QUERIES) - EAGER)

UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow"]


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("key", LAZY)
def test_no_python_and_no_all_pairs_joins(spark, smallest_dir, key):
    plan = plan_of(catalog.QUERIES[key](spark, smallest_dir))
    assert not [node for node in UNWANTED if node in plan]


def test_no_broadcast_without_a_size_check(spark, smallest_dir):
    """Broadcasts come from Spark's own size threshold only: with it off, none is left."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for key in LAZY:
            assert "BroadcastExchange" not in plan_of(catalog.QUERIES[key](spark, smallest_dir)), key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", ["init_current_day", "latest_snapshot", "merge_upsert", "staging_dedup"])
def test_one_row_per_key_needs_no_sort_to_aggregate(spark, smallest_dir, key):
    plan = plan_of(catalog.QUERIES[key](spark, smallest_dir))
    assert "partial_max_by" in plan and "SortAggregate" not in plan


def test_ranked_rows_are_limited_before_the_shuffle(spark, smallest_dir):
    plan = plan_of(catalog.QUERIES["latest_bar_per_ticker"](spark, smallest_dir))
    assert plan.count("WindowGroupLimit (") >= 2


@pytest.mark.parametrize(
    "key", ["stock_ranking", "filtered_ranking", "top_volume", "top_gainers", "top_losers", "top_above_90d", "filtered_moves"]
)
def test_top_lists_do_not_sort_everything(spark, smallest_dir, key):
    plan = plan_of(catalog.QUERIES[key](spark, smallest_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("key", ["dim_daily", "market_trend", "top_volume", "trailing_baselines", "session_snapshot"])
def test_aggregates_combine_before_the_shuffle(spark, smallest_dir, key):
    assert "partial_" in plan_of(catalog.QUERIES[key](spark, smallest_dir))


@pytest.mark.parametrize("key", ["page_list_items", "session_utc", "normalize_ticker", "market_cap_class", "exchange_time_utc"])
def test_row_wise_queries_do_not_shuffle(spark, smallest_dir, key):
    plan = plan_of(catalog.QUERIES[key](spark, smallest_dir))
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_scans_read_only_what_is_used(spark, smallest_dir):
    plan = plan_of(catalog.QUERIES["market_trend"](spark, smallest_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    plan = plan_of(catalog.QUERIES["gainers_today"](spark, smallest_dir))
    assert "IsNotNull(ts)" in plan
