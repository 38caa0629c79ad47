"""Registered queries of the training-data operators against their SQL on the same files."""

import pytest
from oracle import compare, connect

from millrace.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")} == set(range(1, 14))
    assert set(SQL) <= set(QUERIES)
