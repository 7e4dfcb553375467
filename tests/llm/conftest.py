import pytest

EXTRA = ", score double, size long, n long, key string, p string, e string, t string, taken string, kept string, rank int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows, with extra columns whose names clash."""

    def make(rows):
        full = [(i, t, lang, src, None if t is None else len(t), 1.0, 2, 3, "k", "p", "e", "t", "x", "y", 5) for i, t, lang, src in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long" + EXTRA)

    return make


@pytest.fixture(scope="session")
def odd_docs():
    """Null, empty, blank, very long, repeated and tied rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    same = "the same words stand here twice over and over until they end at last"
    return [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, long, "en", "b"), (5, same, "de", "b"), (6, same, "de", None), (6, same, "de", None), (None, same, None, "a"), (7, "ünïcode Wörter ß 中文 🙂 1234 ###", "fr", "c")]
