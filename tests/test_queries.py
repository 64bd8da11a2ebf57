"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from metaloom.plans.registry import QUERIES
from tests.compare import connect, difference



@pytest.fixture(scope="module")
def tables(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf, tables, name):
    assert difference(entry.queries()[name], entry.oracle_sql()[name], spark, tables, sf) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
