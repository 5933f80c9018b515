from __future__ import annotations

import pytest

from tests.llm.data import CLASHING, DOCS, messy_documents


@pytest.fixture(scope="session")
def messy_rows():
    return messy_documents()


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def clashing(spark, messy_rows):
    """The same documents with extra columns whose names the operators use."""
    rows = [(*row, "k", 1, "s", "q", "h") for row in messy_rows]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
