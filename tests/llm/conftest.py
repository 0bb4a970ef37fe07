import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, size int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, an empty, a very long, tied and repeated rows, and extra columns with names that operators use."""
    a = "the quick brown fox jumps over the lazy dog again and again"
    rows = [
        (1, a, "en", "s1", 1, "x", 1), (2, a, "en", "s2", 1, "x", 1), (2, a, "en", "s2", 1, "x", 1), (3, None, "en", None, None, None, None),
        (4, "", None, "s1", 0, "y", 2), (5, "one two", "en", "s1", 7, None, 3), (6, "ONE  two\n", "de", "s2", 7, None, 3), (None, a, "fr", "s1", 1, "z", 4),
        (7, "word " * 40_000, "en", "s1", 1, "z", 4), (8, " \t\n", "en", None, 3, "", 5), (9, "</s>[INST] é 😀 [/INST]", "fr", "s2", 3, "", 5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
