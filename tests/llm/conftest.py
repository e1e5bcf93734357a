import pytest

from codeledger.llm.tables import ready

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return ready(spark)


@pytest.fixture
def documents(llm):
    """Rows of (doc_id, text) as a documents table in several partitions."""

    def make(rows, partitions=3):
        full = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows]
        return llm.createDataFrame(full, COLUMNS).repartition(partitions)

    return make
