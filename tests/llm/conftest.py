import pytest


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) as a documents table, with an extra column of a clashing name."""
    def make(rows, **extra):
        return spark.createDataFrame(
            [(i, t, "en", f"s{k % 2}", k) for k, (i, t) in enumerate(rows)],
            "doc_id long, text string, lang string, source string, n_words long")

    return make


#: Null and empty texts, blanks only, a null id, repeated rows, and words without blanks.
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a b c d"), (4, "same words here again"),
    (4, "same words here again"), (5, "x" * 5000), (6, "é ß ñ É"), (7, "one"),
]
