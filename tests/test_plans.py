"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from civicledger.plans.catalog import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_ALLOWED = {"parquet_magic", "xlsx_files"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInPandas" in text) == (name in PYTHON_ALLOWED)


def test_scans_read_only_what_is_needed(spark, small):
    text = plan(QUERIES["region_balance"](spark, small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_tax:double>" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in text
    assert "PushedFilters: [In(source, [src1,src7])]" in plan(QUERIES["source_filter"](spark, small))


@pytest.mark.parametrize("name", ["page_anchors", "harvest_links", "json_walk_urls", "detect_quarter", "content_sha256", "numeric_clean"])
def test_row_work_needs_no_exchange(spark, small, name):
    assert "Exchange" not in plan(QUERIES[name](spark, small))


def test_large_sides_are_not_broadcast(spark, small):
    """Beyond the size threshold the same queries shuffle, and facts are aggregated before they move."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["region_balance"](spark, small))
        assert "BroadcastHashJoin" not in text
        assert "Exchange hashpartitioning(l_orderkey" in text and "partial_sum" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
