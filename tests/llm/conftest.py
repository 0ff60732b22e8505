import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    def make(rows, parts=3):
        df = spark.createDataFrame(rows, DOCS).repartition(parts)
        return df.withColumns({c: F.lit("x") for c in ("root", "key", "n", "shard", "salt", "start", "kept", "score", "spans")})

    return make
