import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use themselves
        T.StructField("id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("key", T.StringType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """A documents table from texts (ids from 0) or (id, text) pairs, with clashing extra columns."""

    def make(rows, lang=None):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        data = [(i, t, lang, None, len(t) if t is not None else None, 7, 0.5, "k") for i, t in rows]
        return spark.createDataFrame(data, DOCS)

    return make


@pytest.fixture(scope="session")
def small_texts():
    """Whole texts of the small documents table, by id."""
    import duckdb

    return dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY 1").fetchall())
