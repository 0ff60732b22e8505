import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from folio.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s


def one(spark, expr, schema=None, rows=None):
    """Evaluate a Column on a one-row DataFrame."""
    df = spark.createDataFrame(rows or [(1,)], schema or "x int")
    return df.select(expr.alias("v")).collect()[0]["v"]
