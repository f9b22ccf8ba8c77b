"""Rows with everything that an operator must live with, and fixtures over them."""

import pytest
from pyspark.sql import functions as F

#: nulls, empty and blank texts, repeated rows, equal ids, ties, and a very long text
LONG = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i % 977 // 26 % 26)}{chr(97 + i % 977 // 676)} v{chr(97 + i % 13)}" for i in range(40_000))
EDGE = [
    (1, "Hello there world\nthis is a line", "en", "a", 33),
    (1, "Hello there world\nthis is a line", "en", "a", 33),
    (1, "another text under the same id", "en", "a", 30),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n\n \r", "de", "b", 6),
    (None, "no id here at all", "en", "b", 17),
    (None, None, None, None, None),
    (5, "1234 5678 !!", "de", None, 12),
    (6, LONG, "fr", "a", len(LONG)),
    (7, LONG, "fr", "b", len(LONG)),
    (8, "Ünïcödé ñandú größe été", "es", "c", 23),
    (9, "x", "es", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use themselves
CLASHING = ("n", "key", "row", "rank", "size", "taken", "target", "n_lines", "score", "lang_pred", "h", "shard", "a", "b", "k", "value", "component", "r1", "items")


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.withColumns({c: F.lit(f"kept-{c}") for c in CLASHING})


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)
