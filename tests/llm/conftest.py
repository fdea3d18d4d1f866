import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import types as T  # noqa: E402

#: Columns whose names operators also use for what they make.
CLASHING = ["size", "shard", "key", "fp", "words", "_row", "_text", "digest", "kept", "score"]

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASHING],
])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts (or id, text pairs), with nulls beside them and clashing extra columns."""

    def make(texts, lang=None):
        rows = []
        for i, x in enumerate(texts):
            doc_id, text = x if isinstance(x, tuple) else (i, x)
            rows.append((doc_id, text, lang, None, None, *["extra"] * len(CLASHING)))
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make
