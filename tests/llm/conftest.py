import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """The given documents, collected once: (doc_id, text)."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "Été", "漢字", "x1"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [(1, "the alpha of beta gamma\nsecond line here with more words in it", "en", "a", 1),
            (1, "the alpha of beta gamma\nsecond line here with more words in it", "en", "a", 1),
            (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \n\t ", "en", "b", 4),
            (None, "a row without an id and some words", "en", "b", 5), (5, long, "en", "b", len(long)),
            (6, "the alpha of beta gamma\nsecond line here with more words in it", "en", "a", 1),
            (7, "x" * 5000, None, "c", 5000), (8, "🙂" * 40 + " é", "fr", "c", 42)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """``odd_rows`` with extra columns that clash with names operators use."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows, SCHEMA)
    for name in ("score", "predicted", "kept", "size", "key", "shard", "slot", "n", "fp", "line_no", "range", "pos", "_id", "row", "group_id", "class_id", "ref_words", "text_words", "shard_id"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
