import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


AWKWARD = [
    (1, "One two three four five six seven eight nine ten.", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \n\t \n", "b"),
    (5, "One two three four five six seven eight nine ten.", "a"),
    (5, "One two three four five six seven eight nine ten.", "a"),
    (None, "a text without an id", "b"),
    (None, None, None),
    (6, "long " * 30_000 + "x" * 60_000, "b"),
    (7, " " * 300_000 + "zé中文 \U0001f600", "c"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, copies, repeated rows, and columns named like those of the operators."""
    rows = [(i, t, s, 1, 2, "x", "y") for i, t, s in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, size int, n_tokens int, fp string, row string"
    )
