"""The physical plans that the design relies on."""

import os

import pytest

import __spark_entry__ as entry
from tidemark.plans.queries import all_queries
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

WRITING = {"q_incremental", "q_incremental_audit", "q_put_objects"}
PURE = sorted(set(all_queries()) - WRITING)


@pytest.mark.parametrize("name", PURE)
def test_no_cross_join_no_python_no_collected_group(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "collect_list", "SortAggregate"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["q_dedupe_last", "q_first_n", "q_attempt_outcome", "q_upsert_rows"])
def test_hot_groups_are_trimmed_before_the_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_attempts_are_shuffled_once(spark):
    plan = plan_of(entry.queries()["q_attempt_outcome"](spark, SF_DIR)).split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1


def test_search_is_a_top_k_over_a_pushed_filter(spark):
    plan = plan_of(entry.queries()["q_search_page"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "EqualTo(o_orderstatus,O)" in plan


def test_null_checks_are_pushed_to_the_scan(spark):
    plan = plan_of(entry.queries()["q_constraint_report"](spark, SF_DIR))
    assert "Or(IsNull(doc_id),IsNull(text))" in plan


@pytest.mark.parametrize("name,columns", [
    ("q_backlog", "struct<doc_id:bigint>"),
    ("q_run_history", "struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>"),
    ("q_load_metrics", "struct<ts:timestamp_ntz,user_id:bigint,event_type:string>"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(entry.queries()[name](spark, SF_DIR))
