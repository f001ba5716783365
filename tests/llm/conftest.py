import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with the columns of the given table and one more."""
    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), 1.5) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", score double")
    return make
