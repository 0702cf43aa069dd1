from __future__ import annotations

import pytest

from payrisk.llm.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def run_query(spark):
    def run(number: int):
        (name,) = [q for q in QUERIES if q.startswith(f"op{number}_")]
        return QUERIES[name](spark, SF)

    return run


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty, blank and long texts, repeated rows and clashing names."""
    rows = [
        (1, None, 0.5, "a"),
        (2, "", 0.5, None),
        (3, " \n\t ", None, "b"),
        (4, "word " * 40_000, 0.1, "c"),
        (5, "Same text here, twice over.", 0.2, "d"),
        (5, "Same text here, twice over.", 0.2, "d"),
        (6, "Same text here, twice over.", 0.2, "e"),
        (None, "Nobody's text é 😀", None, None),
        (None, None, None, None),
    ]
    schema = "doc_id long, text string, score double, source string"
    names = ["fp", "h", "spans", "base", "n", "root", "key", "segment", "items", "__hit", "label"]
    frame = spark.createDataFrame(rows, schema)
    for name in names:
        frame = frame.withColumn(name, frame["score"])
    return frame


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
