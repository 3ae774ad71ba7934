import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table of texts, or of (doc_id, text) pairs."""
    def make(texts, lang="en", source="s"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in rows], DOC)
    return make
