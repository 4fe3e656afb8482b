"""Fixtures with odd rows, imported by the tests of this folder."""

import pytest

ODD = [None, "", " ", "\n\n", "short text", "x" * 1_500, "word " * 6_000, "Ünï cödé 😀 text\twith\x1c odd  spaces \n and lines "]


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows, and columns with clashing names."""
    rows = [(i, t, "en", "row") for i, t in enumerate(ODD)]
    rows += [(None, "a text without an id that is long enough", None, None), (3, "another text of the same id", None, "th")]
    rows += [rows[4], rows[4], (100, "short text", "fr", "id"), (101, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, th string").selectExpr("*", "th AS id", "1 AS row", "th AS mark")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
