import pytest

EXTRA = {"documents": "doc_id long, text string, lang string, source string, n_chars long"}


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Small ``documents`` tables from (doc_id, text) pairs, with columns named like the operators' own."""
    def make(pairs, parts=3):
        rows = [(i, t, "en", "src", None if t is None else len(t), "x", 7) for i, t in pairs]
        df = spark.createDataFrame(rows, EXTRA["documents"] + ", score string, n_words int")
        return df.repartition(parts)
    return make


@pytest.fixture(scope="session")
def sf_texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


