"""Every registered query runs; those with SQL must agree with DuckDB value by value.

ORACLE_SF_DIR picks the tables (sf0.001 by default, to keep the suite short).
"""

import os

import pytest

import oracle
from zephyrgrid.plans.catalog import ORACLES, QUERIES

DIRECTORY = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(DIRECTORY)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIRECTORY)
    if name in ORACLES:
        problems = [p for p in oracle.compare(df, duck, ORACLES[name]) if p != "no rows"]
        assert not problems
    else:
        assert df.columns
        df.write.format("noop").mode("overwrite").save()
