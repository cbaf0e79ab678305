import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_data import TEXTS  # noqa: E402

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names clash with results and inner columns
    T.StructField("score", T.StringType()), T.StructField("dig", T.StringType()), T.StructField("bucket", T.StringType())])

@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, l, "s", None, "x", "y", "z") for i, t, l in TEXTS], SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
