import os

import pytest

import __spark_entry__ as driver
from checks.harness import compare, connection
from jobweave.llm.oracles import ORACLES
from jobweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(driver.queries()) and set(ORACLES) <= set(QUERIES)
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, connection(SF), SF, name, QUERIES, ORACLES) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline_runs(spark):
    assert driver.queries()["pipeline"](spark, SF).count() > 0
