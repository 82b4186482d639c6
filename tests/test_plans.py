"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as contract
from conftest import SF
from lexweave.catalogue import QUERIES

MAP_ONLY = [
    "t2_people", "t4_cases", "t7_case_figures", "t8_intake_details", "t9_case_details",
    "v1_id", "v3_person_list", "v10_lead_detail_links", "e1_normalise", "s8_collection_unwrap",
]
ONE_SHUFFLE = ["w2_latest_per_key", "c3_primary_key", "e3_phase_log", "a5_posts_by_date"]


def plan(spark, name):
    return contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", MAP_ONLY)
def test_projections_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_one_shuffle_after_a_partial_aggregate(spark, name):
    text = plan(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_" in text


def test_scans_read_only_what_is_used(spark):
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan(spark, "p22_pruned_scan")
    assert "ReadSchema: struct<projectId:bigint,isArchived:boolean>" in plan(spark, "p22_requested_fields")
    figures = plan(spark, "t7_case_figures")
    assert "l_returnflag" in figures and "l_tax" not in figures and "l_discount" not in figures


def test_filters_reach_the_scan(spark):
    pushed = plan(spark, "p17_bounded_ids")
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThanOrEqual(o_orderkey,10813786)]" in pushed


def test_partition_filters_pick_folders(spark):
    text = plan(spark, "s3_partitioned_store")
    assert re.search(r"PartitionFilters: \[isnotnull\(org_id", text)
    # No filter on rows is left over.
    assert not re.search(r"\bFilter \(", text)


LAZY = [n for n in sorted(QUERIES) if not n.startswith(("k", "s1_", "s2_", "t14", "t15", "t16"))]


@pytest.mark.parametrize("name", [n for n in LAZY if "stream" not in n and n != "a8_case_value_clusters"])
def test_no_python_rows_and_no_pairs(spark, name):
    text = plan(spark, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert node not in text
