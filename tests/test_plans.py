"""Plans that must hold at scale."""

from __future__ import annotations

import pytest

from railfeed.checks import QUERIES
from railfeed.checks import fixtures as fx
from railfeed.sources.tables import scan_batch


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fchg_events", "plan_events", "rchg_events", "xml_services"])
def test_documents_are_parsed_once(spark, sf_dir, name):
    assert optimized(QUERIES[name](spark, sf_dir)).count("from_xml(") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_joins(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("name", ["weather_forecast_hourly", "station_latest", "rchg_events", "latest_null_key"])
def test_latest_rows_are_limited_before_the_shuffle(spark, sf_dir, name):
    assert physical(QUERIES[name](spark, sf_dir)).count("WindowGroupLimit") >= 2


def test_batch_scan_prunes_partitions(spark, sf_dir):
    plan = physical(scan_batch(fx.forecast_raw(spark, sf_dir), "open_meteo_20240102000000_00000000"))
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_top_rows_do_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in physical(QUERIES["topn_weather"](spark, sf_dir))
