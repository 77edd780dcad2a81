"""Properties that the physical plans of all registered queries share."""

import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from catalog.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
UNPARTITIONED = re.compile(r"windowspecdefinition\(\S+ (ASC|DESC)")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins_or_global_windows(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not UNPARTITIONED.search(text)
    assert "BatchEvalPython" not in text  # no row-at-a-time Python functions


def test_the_window_pattern(spark, plan):
    assert UNPARTITIONED.search(plan(spark.range(3).selectExpr("row_number() OVER (ORDER BY id) AS r")))
    assert not UNPARTITIONED.search(plan(spark.range(3).selectExpr("row_number() OVER (PARTITION BY id % 2 ORDER BY id) AS r")))
