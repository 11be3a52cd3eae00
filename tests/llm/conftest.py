import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
SF = "/root/testdata/sf0.001"


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(r[0], r[1], *(list(r[2:]) + [None] * (4 - len(r))),
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
