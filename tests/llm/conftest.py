from __future__ import annotations

import pytest

LONG = " ".join(f"w{i % 4001} and" for i in range(60_000))

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (1, "Another text under the same id"),
    (2, None),
    (3, ""),
    (4, " \t\r\n "),
    (5, "x"),
    (None, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (None, None),
    (6, LONG),
    (7, LONG + " end"),
    (8, "na " * 100),
    (9, "日本語 テキスト\n😀😀😀 é\x00"),
    (10, "the QUICK brown fox jumps over the lazy dog near the old river bank today"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty and very long texts, repeated rows and ids, and columns with the names
    that operators use inside."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    return docs.selectExpr(
        "doc_id", "text", "CAST(NULL AS string) AS lang", "'s' AS source", "length(text) AS n_chars",
        "1 AS row", "2 AS digest", "3 AS keep", "4 AS score", "5 AS next", "6 AS names", "7 AS node",
        "8 AS of_doc", "9 AS label", "10 AS `a.b`",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
