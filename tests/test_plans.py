"""Physical-plan properties: pushdown and pruning reach the scan, top-k avoids a global
sort, the flagship never shuffles the customer dimension, and no batch query evaluates a
Python UDF."""

import contextlib
import io

import pytest

from corvid.plans.registry import all_queries

from testdata import SF_SMALL

QUERIES = all_queries()
PURE_MODULES = ("q_shape", "q_agg", "q_kv", "q_join", "q_window", "q_order", "q_docs", "q_flagship")


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF_SMALL).explain("formatted")
    return buf.getvalue()


def test_filters_pushed_to_scan(spark):
    p = plan(spark, "flt_sql")
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in p


def test_projection_pruned_at_scan(spark):
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan(spark, "prj_select")


def test_top_k_without_global_sort(spark):
    p = plan(spark, "ord_limit")
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p


def test_partial_aggregation_before_shuffle(spark):
    p = plan(spark, "wc_clean")
    assert "partial_count" in p


def test_flagship_streams_customer_through_broadcast_semi_join(spark):
    p = plan(spark, "job_top_customers")
    assert "BroadcastHashJoin LeftSemi BuildRight" in p


@pytest.mark.parametrize("name", sorted(n for n, f in QUERIES.items()
                                        if f.__module__.rsplit(".", 1)[-1] in PURE_MODULES))
def test_no_python_udf_in_batch_plans(spark, name):
    p = plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
