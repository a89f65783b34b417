"""Documents that every operator must take: nulls, empties, ties, repeats."""

import pytest
from pyspark.sql import types as T

#: documents plus columns whose names the operators use themselves
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()),
    T.StructField("doc", T.StringType()), T.StructField("words", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("_text", T.StringType()), T.StructField("_hash", T.StringType()),
    T.StructField("trusted", T.StringType()), T.StructField("scores", T.StringType()), T.StructField("length", T.StringType())])

LONG = " ".join(f"w{i % 911}x{i % 13}" for i in range(20_000))

#: nulls, empty and blank texts, ties, repeated rows, other white space, a very long text
EDGES = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "One\x0bTWO\x0cthree four"), (6, "One\x0bTWO\x0cthree four"),
         (None, "no id at all here"), (None, "no id at all here"), (7, "a\x85b c\u00a0d e\x1cf"), (8, "Größe ÉTÉ naïve 中文 😀"),
         (8, "another text under the same id"), (9, LONG), (10, LONG)]


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), *["x"] * 10) for i, t in rows], SCHEMA)


@pytest.fixture
def edges(spark):
    return documents(spark, EDGES).repartition(3)


@pytest.fixture
def nothing(spark):
    return documents(spark, [])
