"""What must and must not be in the physical plans, whatever the data."""

import re

import pytest

import __spark_entry__ as entry
from testbed.queries import registry

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry()))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                   "MapInPandas", "FlatMapGroups", "PythonUDF"):
        assert banned not in plan


def test_gold_scans_read_only_what_they_need(spark):
    plan = plan_of(entry.queries()["gold_attribute_category_by_domain"](spark, SF_DIR))
    columns = {tuple(sorted(re.sub(r"#\d+", "", c) for c in found.split(",")))
               for found in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)}
    assert columns == {("attribute_category", "sample_accession"), ("sample_accession", "sample_domain")}
    assert plan.count("PushedFilters: [IsNotNull(sample_accession)]") == 2


def test_top_organisms_are_cut_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["gold_top_organisms"](spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2


def test_merge_keeps_sources_apart_from_wide_rows(spark):
    """Wide rows are shuffled once, reduced to one per key and task; sources go as bitmap words."""
    for name in ("bronze_runs_combined", "bronze_attributes_combined"):
        plan = plan_of(entry.queries()[name](spark, SF_DIR))
        assert "collect_set" not in plan and "bit_or" in plan
        wide = [line for line in plan.split("\n") if "partial_min(struct(row_order" in line]
        assert len(wide) == 1


def test_distinct_counts_do_not_multiply_rows(spark):
    plan = plan_of(entry.queries()["gold_domain_library_strategy"](spark, SF_DIR))
    assert "Expand" not in plan


def test_single_partition_steps_are_small(spark):
    """Only aggregates of a whole table may end in one task; no sort or window runs in one."""
    for name in sorted(registry()):
        lines = plan_of(entry.queries()[name](spark, SF_DIR)).split("\n")
        for above, line in zip(lines, lines[1:]):
            if "Exchange SinglePartition" in line:
                assert re.search(r"Aggregate|Limit|Sort \[__part", above), (name, above)
