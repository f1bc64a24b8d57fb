"""Rows that every operator has to handle."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside or return.
        T.StructField("score", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("fp", T.StringType()),
    ]
)


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, clashing column names."""
    long = "word " * 30_000 + "x" * 50_000
    rows = [
        (1, "The same text twice over here.", "en", "s", 30, "a", "b", "c"),
        (1, "The same text twice over here.", "en", "s", 30, "a", "b", "c"),
        (2, "", None, None, None, None, None, None),
        (3, None, "en", "s", 0, "a", "b", "c"),
        (4, " \t\n ", "de", "s", 4, "a", "b", "c"),
        (None, "No id but a text.", "en", None, 17, None, None, None),
        (None, None, None, None, None, None, None, None),
        (5, long, "en", "s", len(long), "a", "b", "c"),
        (6, "été à l'école 日本語 🏳️‍🌈 \u00a0 x", "fr", "s", 20, "a", "b", "c"),
        (7, "12345 67890 !!! ???", "en", "s", 19, "a", "b", "c"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def broadcast_steps(df):
    """The steps of a plan that stand below a broadcast, down to the next shuffle (whose rows Spark has sized as they are by then)."""
    depth, shuffle, out = None, None, []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        at = len(line) - len(line.lstrip(" :+-*"))
        shuffle = shuffle if shuffle is not None and at > shuffle else None
        depth = depth if depth is not None and at > depth else None
        if shuffle is None and depth is not None and line[at:].startswith("Exchange"):
            shuffle = at
        elif depth is not None and shuffle is None:
            out.append(line[at:])
        elif depth is None and line[at:].startswith("BroadcastExchange"):
            depth = at
    return out
