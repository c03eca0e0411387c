import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from (doc_id, text, lang, source) rows, with an extra column that clashes with results."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("n_words", "size", "n", "score", "id", "token", "words", "labels"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


# Nulls in every column, empty and word-less texts, ties, repeated rows and one very long text.
EDGE = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, "one two three", "en", None),
    (5, "one two three", "en", "a"), (5, "one two three", "en", "a"), (None, "a row without id", "de", "b"),
    (7, "wörd " * 30000, "de", "b"), (8, "Ünïcode “quoted” \U0001F600 text", None, "b"),
]
