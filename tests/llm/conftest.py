import datetime as dt
import os
import sys

import pytest
from pyspark.sql import Row

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture()
def frame(spark):
    """documents-like frame from (doc_id, text[, lang, source]) rows, with
    extra columns whose names clash with those that operators use."""

    def make(rows, extra=True, partitions=3):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)
        if extra:
            from pyspark.sql import functions as F

            for name in ("size", "node", "d", "k", "start", "name", "kept", "shard", "score", "component"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return make


#: Rows that every operator must take: nulls, empties, repeats, ties, one long text.
ODD = [
    (1, None, None, None),
    (2, "", "en", "s"),
    (3, "   \n\t ", "en", None),
    (4, "one two three", "en", "s"),
    (4, "one two three", "en", "s"),
    (None, "a text without id", "en", "s"),
    (5, "ab " * 60_000, None, "s"),
    (6, "é" * 500 + " <|endoftext|>   'll", "fr", "t"),
]
