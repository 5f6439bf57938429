import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and a in that is it for on with as at by this from or be are was stone river glass lamp orbit cedar violet anchor meadow copper".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randint(0, 999)) if r.random() < 0.3 else "") for _ in range(n))


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeats, ties, and columns whose names the operators use within."""
    rows = [(0, None), (1, ""), (2, "   \n\t "), (3, prose(3, 120)), (4, prose(3, 120)), (5, prose(5, 30_000)), (6, "é" * 300), (7, "x" * 5000), (8, "a b"), (9, "!!! ???"), (9, "!!! ???"), (10, "don't stop 12 <|endoftext|> İstanbul ﬁ"), (11, "a\u0000b \x1c c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("score", "n_words", "key", "bucket", "length", "label", "rank", "at", "doc", "runs", "words", "root", "a", "b", "spans"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
