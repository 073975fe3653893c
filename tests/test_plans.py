"""What the plans must and must not contain."""

import pytest

from oracle import sf_dir
from wayfold.suite.registry import load


def queries():
    """Those of the library proper; the training-data queries have tests of their own."""
    return {name: case.query for name, case in load().items()}


def plan(spark, name):
    df = queries()[name](spark, sf_dir("0.01"))
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = list(queries())


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython",
                 "MapInPandas", "FlatMapGroups", "ExistingRDD"):
        if name in ("placement_counts", "empty_relation") and word == "ExistingRDD":
            continue
        if name == "exists_uncorrelated" and word == "BroadcastNestedLoopJoin":
            continue
        assert word not in text, word


def test_route_join_is_a_broadcast_with_the_box_as_condition(spark):
    line = next(l for l in plan(spark, "daily_frequency").splitlines() if "BroadcastHashJoin" in l)
    assert "__lat_lo" in line and "__lon_hi" in line


def test_time_range_and_columns_reach_the_file(spark):
    scan = next(l for l in plan(spark, "scan_points").splitlines() if "FileScan" in l)
    assert "GreaterThanOrEqual(ts,2024-01-05T06:00)" in scan and "LessThan(ts,2024-01-25T18:00)" in scan
    scan = next(l for l in plan(spark, "slow").splitlines() if "FileScan" in l)
    assert "GreaterThan(value,250.0)" in scan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in scan


def test_days_outside_the_range_are_not_read(spark):
    text = plan(spark, "read_days")
    assert "day#" in text[text.index("PartitionFilters"):text.index("PushedFilters")]
    df = queries()["read_days"](spark, sf_dir("0.001"))
    df.collect()
    files = {name.split("day=")[1][:10] for name in {r[0] for r in df.selectExpr("input_file_name()").collect()}}
    assert min(files) == "2024-01-05" and max(files) == "2024-01-25"


def test_records_are_folded_before_the_first_shuffle(spark):
    text = plan(spark, "daily_frequency")
    first_shuffle = text.rindex("Exchange hashpartitioning")
    assert "partial_min(dateTime" in text[first_shuffle:]


@pytest.mark.parametrize("name", ["path_sample", "first_ids", "sample_ids"])
def test_rank_limits_apply_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "row_number(), " in text and "Partial" in text


@pytest.mark.parametrize("name", ["frequency_top", "top_cells", "cap_rows", "nth_row"])
def test_top_rows_are_not_fully_sorted(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_stop_times_are_read_once(spark):
    assert plan(spark, "route_endpoints").count("lineitem.parquet") == 1


def test_a_histogram_shuffles_no_values(spark):
    text = plan(spark, "histogram")
    assert "hashpartitioning(" not in text and "Window" not in text
    text = plan(spark, "histogram_by_type")
    keys = [line.split("hashpartitioning(")[1] for line in text.splitlines() if "hashpartitioning(" in line]
    assert keys and all(k.startswith("event_type") and "value" not in k for k in keys)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_final_runs_are_shuffled_once(spark):
    """Each branch of the union ends in the one shuffle of records; only edge runs have one more."""
    text = plan(spark, "direction_runs")
    by_slice = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "__slice" in line]
    others = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "__slice" not in line]
    assert len(by_slice) == 2 and len(others) == 1
