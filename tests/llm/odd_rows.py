import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long = " ".join(WORDS[i % 7] + str(i % 13) for i in range(40_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 0.5),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x", 0.5),
        (2, None, None, None, None, None, None),
        (None, "ein kleiner Text ohne Nummer", "de", None, None, "y", None),
        (3, "", "en", "b", 0, None, 1.0),
        (4, " \n\t ", "en", "b", 4, None, 1.0),
        (5, long, "en", "b", len(long), None, 1.0),
        (6, "12345 !!! ###", None, "c", 13, None, 1.0),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score string, fp double"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
