from __future__ import annotations

import pytest
from pyspark.sql import types as T

from sluicemark.llm.queries import on_workers

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size string, copies int, row string, key int, rank int, line string, doc string"


def documents(spark, rows):
    """Rows (doc_id, text, lang, source), with extra columns whose names the operators use themselves."""
    full = [(i, t, lang, s, len(t) if t else None, "x", 7, "row", 1, 2, "line", "doc") for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


EDGE = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog", "en", "a"),  # a repeated row
    (2, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (None, "no id here at all", "en", "a"),
    (5, " \t\n ", "de", None),
    (6, "12345 !!! 678", "en", "c"),
    (7, "word " * 60_000, "en", "b"),  # a very long text
    (8, "x" * 200_000, None, "c"),  # a very long word
    (9, "one", "en", "a"),
    (10, "two words", "en", "b"),
    (11, "The quick brown fox jumps over the lazy dog", "en", "c"),  # a copy
]


@pytest.fixture(scope="session")
def prepared(spark):
    on_workers(spark)
    return spark


@pytest.fixture()
def edge(prepared):
    return documents(prepared, EDGE)


@pytest.fixture()
def nothing(prepared):
    return documents(prepared, [])


@pytest.fixture()
def vectors(prepared):
    def make(rows):
        schema = T.StructType([
            T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("id", T.StringType()),
            T.StructField("v", T.StringType()), T.StructField("rank", T.IntegerType()),
        ])
        return prepared.createDataFrame([(i, v, "id", "v", 0) for i, v in rows], schema)

    return make
