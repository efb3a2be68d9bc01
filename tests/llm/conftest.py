import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside or return
        T.StructField("score", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("_t", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source), with extra columns of clashing names."""

    def make(rows):
        data = [(i, t, "en", s, None if t is None else len(t), "x", "y", "z", None) for i, t, s in rows]
        return spark.createDataFrame(data, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null id, null text, empty and blank texts, one word, a very long text, repeated rows."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    return [(1, "a b c d", "s"), (None, "a b c d", None), (2, None, "s"), (3, "", "t"), (4, " \n\t ", "t"), (5, "one", "s"), (6, long, "u"), (7, "a b c d", "s"), (7, "a b c d", "s"), (8, "Ünï <|endoftext|>   x y  z\x1c!", "u")]
