import random

import pytest

#: Names that the operators use inside.
CLASHES = ["node", "bands", "comp", "w", "n", "h", "bytes", "page", "score", "held_out", "kept", "tokens", "epoch", "host", "path", "rule", "at", "_row", "_mix", "_shard", "_key", "_kept", "_id", "entry", "bucket", "starts", "own", "term", "fault"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a very long text, one very
    long word, ties, repeated rows, and columns with the operators' own names."""
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    long_text = " ".join(rnd.choice(vocab) for _ in range(60_000))
    plain = " ".join(rnd.choice(vocab) for _ in range(80))
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n ", "en", "a", 4), (3, long_text, "en", None, len(long_text)), (4, "x" * 700_000, "en", "b", 700_000),
            (5, plain, "en", "a", 0), (5, plain, "en", "a", 0), (6, plain, "de", "b", 0), (7, "two words", None, "b", 9), (8, plain + " end", "en", "a", 0), (None, plain, "en", "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty_docs(odd_docs):
    return odd_docs.limit(0)
