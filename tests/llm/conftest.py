"""Small tables for the corpus operators."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=None):
        """rows: (doc_id, text) or (doc_id, text, source); extra: names of clashing columns."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F
        for name in extra or []:
            df = df.withColumn(name, F.lit("clash"))
        return df
    return make
