"""Physical-plan guards for the scale properties the README claims."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dedupe_by_key", "upsert_latest", "dominant_value"])
def test_rank_one_is_limited_before_the_shuffle(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


@pytest.mark.parametrize("name", ["grid_zscore", "cell_features", "roc_auc", "gap_histogram"])
def test_no_cartesian_products(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_used_columns(spark):
    plan = plan_of(E.queries()["grid_counts"](spark, SF))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan


def test_date_filters_reach_the_scan(spark):
    plan = plan_of(E.queries()["upsert_latest"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan


@pytest.mark.parametrize("name", ["cell_features", "facility_features", "regression_metrics", "stratified_split", "feature_statistics"])
def test_rows_are_deduplicated_and_aggregated_before_they_are_read_again(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "WindowGroupLimit" not in plan  # the dedupe lies behind a cut
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_cell_rollups_read_one_stored_aggregate(spark):
    plan = plan_of(E.queries()["cell_features"](spark, SF))
    assert "distance_to_center" not in plan.split("Scan ExistingRDD")[1].split("]")[0]
    assert "customer" not in plan
