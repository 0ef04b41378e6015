"""Small documents with every awkward case."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, bin string, h string, score double, rep long, component string, label int, label_id long, digest string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and white-space texts, ties, repeated rows, a very long text, clashing columns."""
    base = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf at night"
    rows = [
        (0, base, "en", "b"),
        (1, base.upper(), "en", "b"),
        (2, base + " again", None, "a"),
        (3, None, "en", None),
        (4, "", "en", "a"),
        (5, " \t\n ", "en", "a"),
        (6, "one two", "en", ""),
        (6, "one two", "en", ""),
        (None, base, "en", "b"),
        (8, "Ünïcode  text   with\x0bodd\x1fspace <|endoftext|> 🙂. Yes", "de", "c"),
        (9, " ".join(f"word{i % 977}" for i in range(30_000)), "en", "c"),
        (10, "x" * 200_000, "en", "c"),
        (11, "1 " * 60_000, "en", "c"),
    ]
    full = [(*r, None if r[1] is None else len(r[1]), 7, "bin", "h", 0.5, 1, "k", 1, 2, "d") for r in rows]
    return spark.createDataFrame(full, SCHEMA).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
