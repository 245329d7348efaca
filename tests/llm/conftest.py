import pytest

from tallybook.llm.staging import Staging

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row int, bytes int, place string, `group` int"


@pytest.fixture
def staging(spark, tmp_path):
    return Staging(spark, str(tmp_path))


@pytest.fixture
def documents(spark):
    """Make a documents table of (doc_id, text[, source]) rows, with extra columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1, 2, "x", 3) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


LONG = " ".join(f"word{i}" for i in range(60_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "one"), (5, LONG), (6, "é ﬁ 🙂 ÀÉ 日本 語"), (7, "x" * 5000)]


@pytest.fixture
def odd():
    """Null, empty, blank, tiny, repeated, very long and foreign texts, and a null id."""
    return ODD
