"""What the physical plans must and must not hold."""

import re

import pytest

from tidepanel.catalog import QUERIES
from tidepanel.operators import windows
from tidepanel.catalog.target import daily_scored

ROOT = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["acps_daily", "acps_hourly", "lags_daily", "rolling_std", "forward_fill", "asof_history", "lag_lookup",
     "seasonal_decompose", "chrono_split", "baseline_table", "target_correlation", "scenario_features"],
)
def test_no_window_puts_all_rows_in_one_task(spark, name):
    text = plan(QUERIES[name](spark, ROOT))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert re.match(r"(entity|_all)#", spec), spec


def test_lags_and_rolling_share_one_exchange(spark):
    scored = daily_scored(spark, ROOT)
    before = plan(scored).count("Exchange hashpartitioning")
    after = plan(windows.daily_window_features(scored)).count("Exchange hashpartitioning")
    assert after == before + 1


def test_raw_tables_are_scanned_once(spark):
    text = plan(QUERIES["acps_daily"](spark, ROOT))
    assert "lineitem" not in text and "orders.parquet" not in text


def test_range_filters_reach_the_scan(spark):
    text = plan(QUERIES["date_range_filter"](spark, ROOT))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_raw_rows_are_not_sorted_for_the_first_of_a_key(spark):
    """Between the scan of the raw rows and the broadcast filter there is no sort and no exchange."""
    text = plan(QUERIES["dedupe_first"](spark, ROOT))
    below = text[text.index("BroadcastHashJoin") :]
    raw = [line for line in below.splitlines() if "lineitem.parquet" in line]
    assert len(raw) == 1
    upto = below[: below.index(raw[0])]
    assert "Sort" not in upto and "Exchange hashpartitioning" not in upto


def test_weather_and_panel_are_scanned_once_or_twice(spark):
    text = plan(QUERIES["chrono_split"](spark, ROOT))
    assert text.count("weather-daily-") == 1 and text.count("daily-counts-") <= 4
