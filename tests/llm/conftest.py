import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) rows."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def given(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")
