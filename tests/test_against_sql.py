"""Registered queries against their SQL counterparts on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from checks.oracle import ORACLE
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_hands_out_all_of_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert compare(spark, SF, QUERIES[name], ORACLE[name]) == ""
