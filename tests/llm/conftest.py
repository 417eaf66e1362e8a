import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""

    def make(rows, schema=None):
        schema = schema or T.StructType.fromDDL(DOCS + ", id long, n long, digest string, size string, cell int")
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 7, 7, "x", "y", 3) for r in rows
        ]
        return spark.createDataFrame(full, schema)

    return make
