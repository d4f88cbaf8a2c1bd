"""Registered queries of the training-data operators against their SQL."""

import pytest

import __spark_entry__ as entry_mod
from murmur.llm import queries
from oracle_check import compare, duck
from tests.conftest import SF_SMALL


def test_registered_beside_the_others():
    assert set(queries.QUERIES) <= set(entry_mod.queries()) and set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    r = compare(spark, key, SF_SMALL, duck(SF_SMALL))
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["values_match"], r
