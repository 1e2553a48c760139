import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows."""
    from packetlens.llm.common import table

    table(spark, "/root/testdata/sf0.001", "region")  # the settings that queries run with

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
