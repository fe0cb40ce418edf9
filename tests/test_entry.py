import os

import pytest

import __spark_entry__ as driver
from checks.harness import compare, connection
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["lang", "n", "chars"] and df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, connection(SF), SF, name) is None
