"""Fixtures of the operator tests; test modules import them by name."""

import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("hash", T.StringType()),
                       T.StructField("pos", T.LongType()), T.StructField("rate", T.DoubleType()),
                       T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names clash with those the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, lang, "x", 7, 0.5, len(t or "")) for i, t, lang in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
