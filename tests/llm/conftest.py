from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """A documents frame from texts, (doc_id, text) pairs, or full rows."""

    def make(*rows):
        full = []
        for k, row in enumerate(rows):
            if row is None or isinstance(row, str):
                row = (k, row)
            full.append((*row, *([None] * (4 - len(row)))))
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string")

    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
