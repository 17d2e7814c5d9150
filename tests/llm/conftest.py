from __future__ import annotations

import random

import pytest

# Edge rows every operator must take: null ids and texts, empty, blank and repeated ones.
EDGES = [
    (1, "one two three"),
    (1, "one two three"),
    (None, "one two three"),
    (None, None),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\f\r "),
    (5, "x" * 50_000),
    (6, "long text here " * 20_000),
    (-7, "ÄÖ ß é　日本 \U0001f600"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows with extra columns, some named like an operator's results or columns."""
    rows = spark.createDataFrame(EDGES, "doc_id long, text string")
    return rows.selectExpr(
        "*", "'x' AS words", "1 AS n_words", "2 AS score", "true AS kept", "3 AS component_id",
        "4 AS n_removed", "'y' AS ids", "'z' AS `key`", "5 AS `_text`",
    )


@pytest.fixture(scope="session")
def vocabulary():
    rnd = random.Random(5)
    return ["".join(rnd.choices("abcdefghij", k=rnd.randint(1, 7))) for _ in range(400)]
