from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and to in is that for with river stone garden window market simple yellow quiet seven copper forest".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", f"{rng.randint(0, 99)}"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty, blank and long texts, repeated rows and ties, and
    columns whose names the operators use themselves."""
    rng = random.Random(3)
    long_text = prose(rng, 30_000)
    shared = prose(rng, 60)
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 3), (None, shared, "en", "b", 9),
            (4, long_text, "en", "b", 9), (5, shared, "en", "b", 9), (5, shared, "en", "b", 9), (6, shared, "de", "c", 9),
            (7, "é\u00a0ü\nshort", "fr", "c", 9), (8, shared + "\n" + shared.upper(), None, None, None),
            (9, "one", "en", "a", 3), (10, "one", "en", "a", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "kept", "h1", "h2", "v", "size", "key", "chunk", "body", "pos", "rank", "k1", "comp"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
