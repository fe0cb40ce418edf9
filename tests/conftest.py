import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def rows(spark):
    """A one-column table ``v`` of texts, and the values of an expression on it, in order."""

    def apply(values, expression, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        out = df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()
        return [row["x"].asDict(True) if hasattr(row["x"], "asDict") else row["x"] for row in out]

    return apply
