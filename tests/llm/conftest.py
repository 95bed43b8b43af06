import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    from mercato.llm.common import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def make_docs(llm):
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return llm.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def folder(llm, tmp_path_factory):
    """Writes tables as <folder>/<name>.parquet."""
    def write(**tables):
        path = str(tmp_path_factory.mktemp("tables"))
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return path

    return write


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, repeated rows, clashing characters, a long text."""
    long_text = " ".join(f"word{i % 977} value {i}." for i in range(60_000))
    return [None, "", "   \n\t ", "x", "same text here", "same text here", "Größe — naïve café 😀 日本語のテキスト", "a b c \x1c d", long_text, "A" * 5000]
