"""Helpers of the operators' tests."""

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a clashing extra column."""
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, "a b c d", "en", "s1", 7, 1), (1, "a b c d", "en", "s1", 7, 1), (2, None, None, None, None, None), (None, "a b c d", "en", "s2", 7, 2),
            (3, "", "en", "s1", 0, 3), (4, long, "de", "s2", len(long), 4), (5, long, "de", None, len(long), 5), (6, " \n\t ", "en", "s1", 4, 6),
            (None, None, None, None, None, None), (7, "Ein ſtück Straße, token: abcdefgh\n", "de", "s3", 30, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long")
