"""Registry rules, and plans that must hold at scale."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


def test_names_match():
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    assert set(oracles) <= set(queries)
    own = {n for n in queries if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(oracles)


@needs_data
def test_entry(spark):
    assert entry_point.entry(spark).count() == 5


@needs_data
@pytest.mark.parametrize("name", [
    "station_summary", "above_group_average", "sales_rollup", "query_drilldown", "grid_visible", "dir_sizes_small",
    "hierarchy_walk", "name_totals", "stream_dead_letter", "conversation_ordinal", "array_inverted_lookup", "interval_overlap",
    "interval_counts", "stream_session_alerts", "stream_minute_deltas", "stream_snapshot_counters", "version_update", "version_merge",
])
def test_small_oracle(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SMALL}/{file}'")
    result = con.sql(entry_point.oracle_sql()[name])
    df = entry_point.queries()[name](spark, SMALL)
    want = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r) for r in df.select(*result.columns).collect()), key=repr) == want


@needs_data
@pytest.mark.parametrize("name", [
    "station_summary", "above_group_average", "three_way_report", "sales_rollup", "name_totals", "topk_deltas",
    "query_drilldown", "grid_visible", "asof_lookup", "device_grid", "range_containment", "cross_grid", "interval_overlap",
    "interval_nested", "interval_counts", "name_search",
])
def test_no_cross_join_and_no_python_in_plans(spark, plan_of, name):
    plan = plan_of(entry_point.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


@needs_data
@pytest.mark.parametrize("name", ["query_drilldown", "running_totals", "islands_sum", "asof_lookup", "grid_visible"])
def test_wide_windows_are_cut_into_chunks(spark, plan_of, name):
    """The windows over table rows are spread by chunk; only the chunk ends are spread by key alone."""
    plan = plan_of(entry_point.queries()[name](spark, SMALL), "simple")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^\n]*)\)", plan)
    assert any("_chunk" in e for e in exchanges)
    assert "Exchange SinglePartition" not in plan


@needs_data
def test_filters_and_columns_reach_the_scan(spark, plan_of):
    plan = plan_of(entry_point.queries()["filtered_topk"](spark, SMALL))
    assert re.search(r"PushedFilters: .*GreaterThan\(o_orderdate", plan)
    assert "TakeOrderedAndProject" in plan
    assert "o_totalprice" not in "".join(re.findall(r"ReadSchema: .*", plan))
    pruned = plan_of(entry_point.queries()["station_summary"](spark, SMALL))
    assert "ReadSchema: struct<event_type:string,value:double>" in pruned
