"""Rows that every operator has to cope with."""

import pytest

from brute_force import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of a caller that operators use as names of their own.
CLASHING = ["key", "tid", "size", "row", "mix_size", "mix_source", "slice", "turn", "id", "found", "core", "row_number"]


def edge_rows():
    twice, long_text = prose(80, 1), prose(60_000, 2)
    return [
        (None, prose(50, 3), "en", "a", 1),
        (None, None, None, None, None),
        (1, None, "en", "a", 0),
        (2, "", "en", None, 0),
        (3, " \n\t ", "de", "", 4),
        (4, twice, "en", "a", 2),
        (4, twice, "en", "a", 2),
        (5, twice, None, "b", None),
        (5, prose(40, 4), "en", "b", 7),
        (-6, long_text, "en", "a", 8),
        (7, "x" * 300_000, "en", "c", 9),
        (8, "x " * 3000, "de", "c", 9),
        (9, "é ß 漢字 \U0001F600 ñandú", "es", "b", 3),
        (10, "12 34 !?", "en", "b", 3),
        (9_000_000_000_000_000_000, "One word", "en", "z", 3),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    return docs.selectExpr("*", *(f"'extra' AS {name}" for name in CLASHING)).repartition(3).cache()


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def frame(spark):
    def build(texts, first=0):
        return spark.createDataFrame([(first + i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)

    return build
