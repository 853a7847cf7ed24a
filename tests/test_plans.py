"""What no plan may hold, and what the important ones must."""

import re

import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return entry_module.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_no_plan_pairs_rows_freely_or_sorts_in_one_task(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name != "dedup_any":
        # Only a grand total may meet in a single partition.
        assert "SinglePartition" not in plan


def test_cut_joins_stored_tables_and_limits_before_the_shuffle(spark):
    plan = plan_of(spark, "take_until_seen")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan_of(spark, "top_n_per_source").count("WindowGroupLimit") == 4


def test_scans_read_only_what_they_need(spark):
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan_of(spark, "url_id")
    assert "text" not in re.findall(r"ReadSchema: (\S+)", plan_of(spark, "rejects"))[-1]


def test_wide_texts_do_not_travel_to_the_report(spark):
    plan = plan_of(spark, "quality_report")
    for exchange in re.findall(r"SortAggregate\(key=\[source#\d+, id#\d+\], functions=\[partial_min\((.*?)\)\]", plan):
        assert "content#" not in exchange.replace("no_content#", "")


def test_ranks_need_no_window_over_rows(spark):
    plan = plan_of(spark, "assign_batches")
    assert "Window" not in plan and "BroadcastHashJoin" in plan
