"""Shapes of physical plans: what is read, joined and kept in the JVM."""

import os
import re

import pytest

from foliospark.plans import matrix
from foliospark.plans.registry import PLUG_POINTS

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(matrix.oracle_sql()) - {"repair_loop", "landing_stream"} - PLUG_POINTS))
def test_no_product_and_no_python(spark, name):
    text = plan(matrix.queries()[name](spark, DATA))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|EvalPython|MapInPandas|MapInArrow", text)


@pytest.mark.parametrize(("name", "columns"), [("strip_html", {"page_id", "html"}), ("code_density", {"doc_id", "text"}), ("bucket_rows", {"user_id", "value"}), ("cost_calc", {"doc_id", "lang", "n_chars"}), ("lane_fanin", {"conv_id", "turn", "text"})])
def test_scans_read_only_what_is_used(spark, name, columns):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(matrix.queries()[name](spark, DATA)))
    assert {x.split(":")[0] for x in read[1].split(",")} == columns


@pytest.mark.parametrize(("name", "most"), [("strip_html", 0), ("code_density", 0), ("extract_json", 0), ("lane_fanout", 0), ("lane_fanin", 1), ("status_by_batch", 1), ("latest_pending", 1), ("newest_override", 1), ("bucket_rows", 1)])
def test_shuffles(spark, name, most):
    text = plan(matrix.queries()[name](spark, DATA))
    assert len(re.findall(r"\bExchange hashpartitioning", text)) <= most


@pytest.mark.parametrize("name", ["derived_crops", "column_histogram", "image_gate"])
def test_tables_that_grow_are_not_broadcast(spark, name):
    assert "Broadcast" not in plan(matrix.queries()[name](spark, DATA))


def test_repairs_are_stored_and_not_made_again(spark):
    assert "MapInPandas" not in plan(matrix.queries()["repair_loop"](spark, DATA))
