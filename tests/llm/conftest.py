import duckdb
import pytest

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of the small documents table."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()


@pytest.fixture(scope="session")
def frame(spark):
    """Makes a documents table from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], SCHEMA
        )

    return make
