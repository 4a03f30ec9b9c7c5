"""What the physical plans must and must not hold."""

import os
import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
TABLE_QUERIES = sorted(n for n in queries() if not n.startswith("stream_"))


def plan(spark, name: str) -> str:
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_cross_join_and_no_python_in_hot_paths(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("InPandas" in text) == (name == "login_fail_burst")


@pytest.mark.parametrize(
    "name", ["hot_items", "hot_urls", "ad_click_cap", "ad_blacklist", "area_top3_ads"]
)
def test_ranking_is_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


@pytest.mark.parametrize("name", ["hot_items", "page_view", "unique_visitor"])
def test_filter_and_columns_reach_the_scan(spark, name):
    text = plan(spark, name)
    assert "EqualTo(event_type,view)" in text
    assert "value:double" not in text


@pytest.mark.parametrize(
    "name",
    ["login_fail_pairs", "temp_jump", "temp_rising", "running_count", "order_pay_match",
     "order_timeout_cep", "sensor_rolling_min", "login_fail_burst"],
)
def test_ordered_steps_over_rows_are_cut_by_time(spark, name):
    """Every window over event rows is partitioned by (key, chunk); only chunk summaries are not."""
    for spec in re.findall(r"windowspecdefinition\(([^)]*?)specifiedwindowframe", plan(spark, name)):
        assert "_chunk#" in spec


def test_interval_join_keys_hold_the_bucket(spark):
    assert re.search(r"Join \[tx#\d+L?, _bucket#\d+L?\]", plan(spark, "interval_join"))
