import pytest
from pyspark.sql import types as T

from mendframe.llm.common import ship

LONG = "lorem ipsum dolor. " * 20_000


def hostile_rows():
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing extra columns."""
    texts = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "b"),
        (3, None, "en", "a"),
        (4, "", None, "a"),
        (5, "   \n\t ", "fr", None),
        (None, "Texte sans identifiant, écrit à la main.\nDeuxième ligne.", "fr", "b"),
        (None, None, None, None),
        (6, LONG, "en", "a"),
        (7, "word", "en", "c"),
        (7, "other text of the same id", "en", "c"),
        (8, "Licensed under the Apache License, Version 2.0.\nMail me at a.b@example.org or 10.0.0.1.", "en", "c"),
        (-9, "ÀÉÎ 😀 İ Σ <|endoftext|> x", "zz", "é"),
    ]
    return [(*t, None if t[1] is None else len(t[1]), "x", 1, "y", 2) for t in texts]


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("fp", T.IntegerType()),
        T.StructField("_key", T.StringType()),
        T.StructField("tokens", T.IntegerType()),
    ]
)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def hostile(spark):
    return spark.createDataFrame(hostile_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
