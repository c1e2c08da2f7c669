import pytest
from pyspark.sql import types as T


@pytest.fixture()
def frame(spark):
    """documents-like rows: (id, text, lang, source, n_chars), plus columns with clashing names."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("id", T.LongType()), T.StructField("chunk", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("row", T.StringType())])

    def make(rows):
        full = [tuple(r) + (None, "s")[: max(0, 4 - len(r))] for r in rows]
        return spark.createDataFrame([(*r[:4], -1, "c", -2, "r") for r in full], schema)

    return make


#: Texts that every operator must survive.
ODD = [None, "", " \n\t ", "\n\n", "word", "a b", "é ü ñ", "x" * 5000, "y z " * 20000, "<|endoftext|> | $ %", "\x1c\x85  q"]


@pytest.fixture()
def odd(frame):
    rows = [(i, t) for i, t in enumerate(ODD)]
    return frame([*rows, *rows, (None, "no id at all"), (None, None)])
