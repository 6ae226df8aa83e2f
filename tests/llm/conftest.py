from __future__ import annotations

import pytest

# Every case an operator has to bear: nulls, empty and blank texts, no letters, a long text,
# repeated rows, a shared id, and columns whose names clash with those the operators use.
LONG = " ".join(f"word{i % 977} and thing{i % 1009}" for i in range(30_000))
ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
    (2, None, None, None),
    (3, "", "en", ""),
    (4, " \n\t ", "de", "b"),
    (5, "12 34 !!", None, "b"),
    (6, LONG, "en", "a"),
    (7, "Ünïcödé — ñandú 漢字 😀  end", "de", None),
    (8, "one", "de", "c"),
    (8, "one two", "de", "c"),
    (None, "no id here at all", "en", "a"),
    (None, None, None, None),
]


@pytest.fixture
def odd_docs(spark):
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(ODD_ROWS, schema)
    clashing = ("n_words", "score", "row", "spans", "key", "size", "rank", "severity", "toxic", "hash", "_text")
    return docs.selectExpr("*", *[f"'x' AS `{c}`" for c in clashing])


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
