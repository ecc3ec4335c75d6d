import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text[, source]) tuples, in several partitions."""
    def make(rows, parts=3):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, DOC_SCHEMA).repartition(parts) if rows else spark.createDataFrame([], DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    from tests.conftest import SF_SMALL
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
