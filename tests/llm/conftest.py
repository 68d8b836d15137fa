import pytest

LONG = "alpha beta gamma delta " * 40_000

#: Nulls in any column, empty and blank texts, a very long one, ties and repeated rows.
MESSY = [
    (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "s", 10, 0.5, "x"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "s", 0, 0.1, "x"),
    (4, " \n\t ", "de", "s", 4, 0.1, "x"),
    (5, LONG, "en", "s", 1, 0.1, "x"),
    (6, "Ünïcödé ſtraße λόγος 日本語 🙂 password=abcdef123456XYZ", "de", "t", 1, 0.1, "x"),
    (7, "The quick brown fox jumps over the lazy dog and runs away", "en", "s", 10, 0.5, "x"),
    (7, "The quick brown fox jumps over the lazy dog and runs away", "en", "s", 10, 0.5, "x"),
    (None, "a text without an id", "en", "s", 1, 0.1, "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string"


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(MESSY, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    """Tables of some 1,000 documents."""
    return "/root/testdata/sf0.01"
