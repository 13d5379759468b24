"""What the plans must and must not contain, whatever the size of the tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from tallywake.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables here")


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_or_row_functions(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SinglePartition"):
        assert node not in text


@pytest.mark.parametrize("name,columns", [
    ("hot_items_topn", "ts:timestamp_ntz,event_type:string,props:string"),
    ("page_views_hourly", "ts:timestamp_ntz,event_type:string"),
    ("unique_visitors_hourly", "ts:timestamp_ntz,user_id:bigint,event_type:string"),
    ("login_fail_pair", "event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string"),
    ("late_rows", "event_id:bigint,ts:timestamp_ntz")])
def test_scans_read_only_what_is_used(spark, name, columns):
    text = plan(spark, name)
    assert text.count("ReadSchema") == text.count(f"ReadSchema: struct<{columns}>")


@pytest.mark.parametrize("name", ["hot_items_topn", "hot_items_sql", "page_views_hourly", "unique_visitors_hourly"])
def test_event_type_reaches_the_scan(spark, name):
    assert "EqualTo(event_type,view)" in plan(spark, name)


@pytest.mark.parametrize("name", ["hot_items_topn", "hot_items_sql", "hot_pages_topn", "click_cap_total", "click_blacklist"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    assert ", Partial" in plan(spark, name) and "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", ["login_fail_burst", "login_fail_pair", "login_fail_pattern", "order_pay_pattern",
                                  "pay_receipt_match", "ad_clicks_sliding", "market_by_channel", "hot_pages_topn"])
def test_keys_are_shared_out_by_time_chunk(spark, name):
    shuffles = [part.split(")")[0] for part in plan(spark, name).split("Exchange hashpartitioning(")[1:]]
    assert any("chunk" in s for s in shuffles)
