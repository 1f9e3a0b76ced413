import pytest


@pytest.fixture(scope="session", autouse=True)
def scratch(spark):
    yield
    from cropcube.llm.common import clean_scratch
    clean_scratch(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return make
