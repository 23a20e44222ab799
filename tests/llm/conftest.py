from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty and very long texts, ties, repeated rows and clashing extra columns."""
    long_text = " ".join(f"word{i % 977} is number{i}" for i in range(60_000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, "Same text of a few WORDS here", "en", "a"),
        (4, "same text of a few words here", None, "a"), (4, "same text of a few words here", None, "a"),
        (None, "same text of a few words here", "en", ""), (5, "one", "de", "b"), (6, long_text, "en", "b"),
        (7, long_text, "en", "b"), (8, "Äpfel ÄPFEL 😀 <|endoftext|>  x", "de", "c"), (9, "123 456 --", "fr", "c"),
    ]
    return spark.createDataFrame(
        [(*r, 1, 2, 3, "x", "y", 0.5) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, sender int, seq long, row string, "
        "digest string, size double")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
