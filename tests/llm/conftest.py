import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """A documents table of (doc_id, text, source) rows, with a column whose name clashes with inner ones."""

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    return [
        (1, "alpha beta gamma delta", "a"), (2, "alpha beta gamma delta", "b"), (2, "alpha beta gamma delta", "b"), (3, "", "a"),
        (4, None, None), (5, "   \n\t ", "a"), (6, long, "b"), (7, long + " tail", "b"), (None, "alpha beta gamma delta", "c"),
        (8, "Été où l'île", "c"), (9, "one", "a"),
    ]
