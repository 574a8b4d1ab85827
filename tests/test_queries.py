"""Every registered query against its comparison SQL on the given tables."""

from __future__ import annotations

import importlib.util
from pathlib import Path

import pytest
from compare import connect, difference, type_difference

FOLDER = "/root/testdata/sf0.01"
SPEC = importlib.util.spec_from_file_location("spark_entry", Path(__file__).resolve().parent.parent / "__spark_entry__.py")
ENTRY = importlib.util.module_from_spec(SPEC)
SPEC.loader.exec_module(ENTRY)
ORACLES = {n: sql for n, sql in ENTRY.oracle_sql().items() if n not in ENTRY.LLM_ORACLES}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_comparison_sql():
    assert set(ENTRY.queries()) - set(ENTRY.LLM_QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ["fct_uptime_daily", "mart_uptime_slo", "serve_uptime_slo"])
def test_ties_are_exact_on_more_data(spark, name):
    folder = "/root/testdata/sf0.1"
    assert difference(ENTRY.queries()[name](spark, folder), connect(folder), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = ENTRY.queries()[name](spark, FOLDER)
    assert type_difference(df, duck, ORACLES[name]) is None
    assert difference(df, duck, ORACLES[name]) is None


def test_entry_is_not_empty(spark):
    assert not ENTRY.entry(spark).isEmpty()
