import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, a clashing column name."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat with a hat and the dog ran off", "en", "a", 1, "x"), (2, None, "en", None, None, None), (3, "", None, "b", 0, "y"),
        (4, long, "en", "a", 5, "z"), (5, long, "en", "a", 5, "z"), (5, long, "en", "a", 5, "z"), (None, "a text without an id at all", "en", "b", 2, "q"),
        (6, " \n\t ", "en", "b", 2, "q"), (7, "one two", "de", "b", 2, "q"), (8, "one two", "de", "b", 2, "q"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank string")
