"""The operators' queries against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from metaloom.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert difference(QUERIES[name], ORACLES[name], spark, connect(sf), sf) is None
