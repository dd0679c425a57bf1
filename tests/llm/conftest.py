import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rep long"   # rep clashes with inner names


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, an extra column."""
    long_text = " ".join(f"w{i % 977} x{i % 31}." for i in range(30_000))
    rows = [(1, None, "en", "a", None, 0), (2, "", None, "a", 0, 1), (3, " \n\t ", "en", None, 3, 2), (4, long_text, "en", "b", 1, 3),
            (5, "one two three.", "en", "b", 14, 4), (5, "one two three.", "en", "b", 14, 4), (6, "One two three.", "en", "b", 14, 5),
            (7, "é ü 😀 " * 200, "de", "c", 1, 6), (None, "no id here", "en", "a", 10, 7)]
    return spark.createDataFrame([(*r[:4], r[4], r[5]) for r in rows], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
