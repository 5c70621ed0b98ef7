"""Documents with every odd case, and columns whose names clash with what operators use."""

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_words string, score string, label string, kept int, "
    "_text string, _row int, node string, host string, verdict int, held_out string, lang_pred int, ids int, formatted string"
)


def rows_of(pairs):
    """Documents with columns whose names clash with what operators add or use."""
    return [(i, t, "en", None, "x", "x", "x", 7, "x", 7, "x", "x", 7, "x", 7, 7, "x") for i, t in pairs]


LONG = "lorem ipsum dolor sit amet " * 20_000
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, LONG), (7, LONG), (None, "a b c d e"), (None, None),
    (8, "same text here now"), (8, "same text here now"), (9, "x" * 200_000), (10, "\x00\x7f \u00e9\u00c9 \U0001f642 \u4e2d\u6587 \u03a3\u03c2"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(ODD), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


SMALL = "/root/testdata/sf0.001"
