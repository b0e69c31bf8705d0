import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage_reads_are_pruned(spark):
    plan = _plan(E.queries()["panel_composition"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan
    assert all("comp_a_premium" not in s for s in schemas)
    assert "PushedFilters" in plan


def test_core_plans_have_no_pair_joins_or_row_udfs(spark):
    q = E.queries()
    for key in ("coverage_by_month", "avg_top_n", "historical_anchor_segmean", "premium_box", "monthly_summary"):
        plan = _plan(q[key](spark, "/root/testdata/sf0.01"))
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
            assert bad not in plan, (key, bad)


def test_small_tables_are_joined_without_shuffling_quotes(spark):
    """Stage rows meet cell, month and segment tables in broadcast joins: no sort-merge join is planned."""
    q = E.queries()
    for key in ("historical_anchor_segmean", "reference_features", "avg_topn_by_month"):
        plan = _plan(q[key](spark, SF.replace("0.001", "0.01")))
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan, (key, plan)
