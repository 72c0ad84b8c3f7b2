"""Every registered query against its SQL twin on the smallest tables, and the shape of the plans."""

import os
import re

import pytest

import __spark_entry__ as contract
from oracle import connect, difference

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_rows_as_sql(spark, small, connection, name):
    assert difference(QUERIES[name](spark, small), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_rows_without_sql(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_set_difference_has_rows_and_a_null(spark, scale):
    found = QUERIES["set_difference"](spark, f"/root/testdata/{scale}").collect()
    assert found and any(row.nationkey is None for row in found)


# Plans: no Python per row, no product of tables, no window that gathers all rows in one task.
_LAZY = [
    "band_summary", "feature_frame", "month_split", "year_split", "null_report", "unseen_categories", "category_checks",
    "allowed_values", "align_full_outer", "align_identical", "union_missing", "record_validation", "group_lists",
    "profile_report", "row_index", "fold_index", "shuffled_rows", "standardised", "validate_splits", "psi",
]


@pytest.mark.parametrize("name", _LAZY)
def test_plan(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for operator in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert operator not in plan, operator
    assert not re.search(r"Window \[", plan)


def test_no_forbidden_calls():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(os.path.join(root, "hammerprice")):
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as handle:
                    text = handle.read()
                assert "localCheckpoint" not in text and "crossJoin" not in text, name
