"""Documents with every awkward case."""

from __future__ import annotations

import pytest
from plainly import SCHEMA, awkward_rows


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame(awkward_rows(), SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
