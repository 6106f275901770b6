import pytest

from fleetgrain.llm.common import prepare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents(llm):
    return llm.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def labels(llm):
    return llm.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(llm):
    return llm.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="session")
def pages(llm):
    return llm.read.parquet(f"{SF}/pages.parquet")


DOC = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "stratum string, rep long, block long, token long, mix_size long, part int, whole string, items string, quality int"
)


@pytest.fixture(scope="session")
def make_docs(llm):
    """Documents from (doc_id, text[, lang[, source]]), with more columns whose names operators use inside."""

    def make(rows):
        full = [(*r, *(None, "en", "s")[len(r) - 1 :], 0, "x", 1, 2, 3, 4, 5, "w", "i", 1) for r in rows]
        return llm.createDataFrame(full, DOC)

    return make
