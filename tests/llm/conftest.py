import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import odd  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return odd.documents(spark).cache()


@pytest.fixture(scope="session")
def none(spark):
    return odd.empty(spark)


@pytest.fixture(scope="session")
def table_docs(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet")
