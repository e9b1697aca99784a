from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shopfloor.session import ship_package


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """A table of documents with columns whose names operators use inside."""
    kind = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("text", StringType()),
            StructField("key", StringType()),
            StructField("row", LongType()),
            StructField("n", LongType()),
            StructField("spans", StringType()),
        ]
    )

    def make(rows):
        return spark.createDataFrame([(i, t, "k", 1, 2, "s") for i, t in rows], kind)

    return make
