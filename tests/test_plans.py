"""Plan shape: no Python UDF in any registered query, pruned and filtered
scans, bounded dimensions broadcast, no full outer join in the recommender."""

import pytest

import __spark_entry__ as entry
from bazaar.plans import bindings
from bazaar.plans import marts as M
from bazaar.sources import dimensions as D
from tests.fixtures import load, write_raw

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_no_python_udf_no_cross_join(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p
    # no cross join of any kind
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_is_pruned(spark):
    p = plan(entry.queries()["orders_payment"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in p


def test_filter_reaches_scan(spark):
    df = entry.queries()["leads_by_origin"](spark, SF).where("origin = 'click'")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p


def test_bounded_dimension_broadcast(spark, tmp_path):
    raw = load(spark, write_raw(str(tmp_path)))
    m2 = M.order_products_payments(raw["order_items"], raw["products"], D.category_translation(spark),
                                   raw["order_payments"])
    assert "BroadcastHashJoin" in plan(m2) or "BroadcastExchange" in plan(m2)


def test_recommender_rows_inner_joins(spark, tmp_path):
    raw = load(spark, write_raw(str(tmp_path)))
    rows = M.recommender_rows(raw["order_items"], raw["products"], raw["order_reviews"], raw["orders"])
    p = plan(rows)
    assert "FullOuter" not in p and "LeftOuter" not in p


def test_m14_joins_counts_not_rows(spark):
    df = entry.queries()["order_rows_by_month"](spark, SF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    # both join inputs are aggregates per order (count over the join)
    assert optimized.count("Aggregate [order_id") >= 2


def test_topk_uses_group_limit(spark):
    p = plan(entry.queries()["similar_users"](spark, SF))
    assert "WindowGroupLimit" in p
