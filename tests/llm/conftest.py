import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) pairs."""
    def make(texts, lang="en"):
        rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, lang, "s", len(t) if t else 0) for i, t in rows], DOCS)
    return make
