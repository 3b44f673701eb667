import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # Names that the operators use for their own results and columns in between.
    T.StructField("key", T.StringType()), T.StructField("rest", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("n_lines", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("__id", T.StringType()),
])


@pytest.fixture(scope="session")
def table_of(spark):
    """Documents with extra columns that clash, from (doc_id, text) pairs."""

    def make(pairs):
        rows = [(i, t, "xx", *["mine"] * (len(SCHEMA) - 3)) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def given(oracle):
    """(doc_id, text) of the given documents."""
    return oracle.sql("SELECT doc_id, text FROM documents").fetchall()


@pytest.fixture(scope="session")
def odd():
    """Null ids and texts, empty and blank texts, ties, repeats, a very long text and a long run without spaces."""
    line = "This line is shared by many of the documents here."
    long = " ".join(f"word{k % 5000}" for k in range(60_000))
    return [
        (1, None), (2, ""), (3, " \t\x0b\n"), (4, "one two"), (5, "one two"), (6, "ONE two"), (7, long), (8, long + " end"),
        (9, "a" * 50_000), (10, f"{line}\nfirst"), (11, f"{line}\nsecond"), (12, f"  {line.upper()} \nthird"),
        (13, "mail me at jo.doe@example.org or +44 (20) 7946-0958, 10.0.0.255, 4111 1111 1111 1111."),
        (14, "1" * 30_000), (15, "@" * 500 + "a" * 500), (16, "naïve Ünï İstanbul. x² 日本語。 👍🏽"), (17, "\n\n\n"),
        (-5, "negative id with several words in it for good measure"),
    ]
