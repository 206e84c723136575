import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, __key string, __id string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source); extra columns have names that operators might use themselves."""

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "extra", "extra", "extra") for i, t, s in rows]
        return spark.createDataFrame(full, DOC)

    return make
