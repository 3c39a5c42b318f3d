from __future__ import annotations

import pytest

#: Null, empty and blank texts, repeated rows and ids, a tie, personal data, a very long text, special tokens, odd spaces.
SHARED = "the quick brown fox jumps over the lazy dog while many other animals look on from the green hill nearby and wait"
CASES = [
    (1, SHARED, "en", "a", 10),
    (2, SHARED, "en", "a", 10),
    (2, SHARED, "en", "a", 10),
    (3, SHARED + " today", "en", "b", None),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\r\n", "en", "b", 4),
    (None, "one two three", "fr", None, 13),
    (None, None, "fr", None, None),
    (7, "Écrivez à Jean.Dupont@mail.example.com ou +33 1 23 45 67 89, ip 10.0.0.256 et 10.0.0.25 🙂", "fr", "a", 1),
    (8, "card 4111 1111 1111 1111 and 4111-1111-1111-1112\nReleased under the MIT License.", "en", "a", 1),
    (9, "lorem ipsum dolor sit amet consectetur " * 4000, "la", "b", 1),
    (10, "a<|endoftext|>b \x1c c d ΣΑΣ", "el", "b", 1),
    (11, "x" * 3000, "xx", "b", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(CASES, SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(docs):
    """Columns named like results and like the operators' own."""
    from pyspark.sql import functions as F

    names = ("kept", "llr", "n_words", "ids", "spans", "size", "shard", "slot", "selected", "sample_key", "th", "cls", "grp", "part", "license")
    return docs.select("*", *(F.lit("own").alias(n) for n in names))


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, None), (9, 0, 0), (None, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
