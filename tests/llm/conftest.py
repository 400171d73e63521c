from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    passage = " ".join(f"passage{i} of some length" for i in range(40))
    rows = [
        (1, None, "en", "a"),
        (2, "", None, None),
        (3, " \n\t ", "en", "a"),
        (4, passage, "en", None),
        (4, passage, "en", None),
        (5, f"start here {passage} and then an end of its own", "xx", "a"),
        (6, "one", "en", "b"),
        (7, "two words", "en", "b"),
        (8, "é" * 150 + "ü" * 150, "fr", "b"),
        (9, "x" + "é" * 150, "fr", "b"),
        (10, "word " * 30_000, "en", "b"),
        (11, "\0\x1c  \U0001f600 <|endoftext|> Σ İ ﬁ", None, "c"),
        (None, "a text without an id that is long enough to be kept by all of the rules that there are here today", "en", "c"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    frame = spark.createDataFrame(rows, schema)
    extra = {name: frame["doc_id"] for name in ("row", "id", "key", "tag", "doc", "host", "length", "start", "span", "kept", "_id")}
    return frame.selectExpr("*", "cast(length(text) as bigint) n_chars").withColumns(extra)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
