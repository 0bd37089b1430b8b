"""Plan-shape regressions: the properties the operators were built for."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["item_cf_top10", "content_pairs", "online_recs", "online_recs_asof",
                                  "factor_topk", "rating_upsert", "recs_to_products"])
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan_of(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_k_uses_window_group_limit(spark):
    p = plan_of(E.queries()["item_cf_top10"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p
    p = plan_of(E.queries()["recent_ratings_k"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_scans_are_pruned(spark):
    p = plan_of(E.queries()["rate_more_products"](spark, SF_SMALL))
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("l_extendedprice" not in s and "l_comment" not in s for s in schemas)
    assert any(s.strip() == "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" for s in schemas)


def test_hot_list_is_a_take_ordered(spark):
    p = plan_of(E.queries()["most_rated_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
