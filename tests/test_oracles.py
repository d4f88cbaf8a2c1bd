"""Every registered query against its DuckDB oracle on the smallest scale factor
(the driver repeats this at sf0.01)."""

import pytest

from oracle_check import compare, duck
from tests.conftest import SF_SMALL

import __spark_entry__ as entry_mod
from murmur.plans.catalog import QUERIES

# the training-data queries have their own tests
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(entry_mod.oracle_sql()) >= set(KEYS) and set(entry_mod.queries()) >= set(KEYS)
    assert len(KEYS) == 33


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, SF_SMALL, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "intent_category" in df.columns


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "StringType()": "VARCHAR",
                 "BooleanType()": "BOOLEAN", "TimestampType()": "TIMESTAMP", "DoubleType()": "DOUBLE",
                 "DateType()": "DATE"}


@pytest.mark.parametrize("key", KEYS)
def test_column_types_match_oracle(spark, con, key):
    s = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType))
         for f in entry_mod.queries()[key](spark, SF_SMALL).schema.fields}
    d = {r[0]: r[1] for r in con.execute("DESCRIBE " + entry_mod.oracle_sql()[key]).fetchall()}
    assert s == d
