"""Plan guards over every registered query (built on the smallest tables)."""

import pytest

from ledgerline.plans.registry import QUERIES
from ledgerline.plans.inspect import physical_plan
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_plan_is_distributed_and_native(spark, name):
    plan = physical_plan(QUERIES[name](spark, SF001))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"
    # the returned plans never run Python per row or per batch
    assert "MapInPandas" not in plan and "PythonUDF" not in plan, name
    # every scan of a test table reads a pruned column set (never a 'select *' of a wide table
    # unless the query returns all its columns)
    assert "ReadSchema" in plan or "InMemoryRelation" in plan or "Range" in plan or "LocalTableScan" in plan, name


def _scans(spark, name):
    from ledgerline.plans.inspect import scan_summary
    return scan_summary(QUERIES[name](spark, SF001))


def test_filters_and_columns_reach_the_scan(spark):
    (daily,) = _scans(spark, "order_daily_agg")
    assert "IsNotNull(l_quantity)" in daily["PushedFilters"] and "IsNotNull(l_extendedprice)" in daily["PushedFilters"]
    assert daily["ReadSchema"].count(":") == 4                     # 4 of lineitem's columns
    (count,) = _scans(spark, "orders_clean_count")
    assert count["ReadSchema"] == "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>"
    (ticks,) = _scans(spark, "tick_quality")
    assert "GreaterThan(value,0.0)" in ticks["PushedFilters"] and "props" not in ticks["ReadSchema"]


def test_day_range_prunes_partitions(spark):
    (scan,) = _scans(spark, "rt_parquet_prune")
    assert "trade_date_str" in scan["PartitionFilters"] and ">= 1996-03-01" in scan["PartitionFilters"]
    assert "trade_date_str" not in scan["ReadSchema"]               # partition values come from paths
