"""Small tables with the awkward rows that every corpus operator has to bear."""

import pytest
from pyspark.sql import types as T

#: Other columns whose names the operators also use inside.
CLASHING = ["id", "row", "block", "part", "key", "h", "n", "range", "sig", "bits", "edge", "path", "html", "gone", "kept_id", "score"]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASHING]])

LONG = " ".join(f"word{i % 977} and{i}" for i in range(30_000))
SENTENCE = "the quick brown fox jumps over the lazy dog while seven old wizards quietly mix a jug of strong purple ink again tonight"
AWKWARD = [
    (1, "plain text of a few words"), (2, None), (3, ""), (4, " \n\t "), (5, "plain text of a few words"), (6, LONG),
    (7, SENTENCE), (8, SENTENCE + " for good"), (9, "Ünïcode ñandú 日本語 😀 é"), (10, LONG + " tail"), (None, SENTENCE),
    (11, "one"), (11, "one"), (12, "aaaa " * 50), (13, "!!! ... ###"), (14, None), (15, "Plain TEXT of a few words")]


@pytest.fixture(scope="session")
def table(spark):
    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward(table):
    return table(AWKWARD)


@pytest.fixture(scope="session")
def empty(table):
    return table([])
