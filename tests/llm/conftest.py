import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, score double, size long, count long, items string"


@pytest.fixture(scope="session")
def make_docs():
    """Rows of (doc_id, text) as a table of documents with extra columns of clashing names."""

    def make(spark, rows):
        full = [(i, t, "en" if i is None or i % 2 else None, None if i == 3 else f"src{(i or 0) % 3}", None if t is None else len(t), 1, 0.5, 7, 2, "x") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def texts():
    """Odd texts: null, empty, white space, short, repeated, long, other scripts, control characters."""
    words = "the quick brown fox jumps over a lazy dog while many small birds sing in tall old trees near every quiet river bank".split()
    long = " ".join(words[(i * 7 + i // 5) % len(words)] + str(i % 97) for i in range(6000))
    return [None, "", " \t\n", "one", "Two Words", " ".join(words), " ".join(words), "ÀÉß straße 中文 😀 a\x1cb\x85c", long, "x" * 5000, "Mixed CASE, with; punctuation!  and   runs\n\nof space", "<|endoftext|> inside"]
