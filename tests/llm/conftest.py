import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int, part string, _host string, score double"


@pytest.fixture
def docs(spark):
    """Rows of documents from (doc_id, text, source), with clashing extra columns."""

    def make(rows, lang="en"):
        full = [(i, t, lang, s, len(t or ""), "extra", "extra", 0.5) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return make
