import re

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def words(text, lower=False):
    text = (text or "").translate(LOWER) if lower else (text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"wort{i % 977}" for i in range(60_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n", "en", None, 3),
        (4, long, "en", "a", len(long)),
        (5, "x" * 100_000, "de", "a", 100_000),
        (6, "Ein Satz mit äöü und 日本語\nnoch eine Zeile", "de", "b", 40),
        (7, "same text here twice over", "en", "b", 25),
        (7, "same text here twice over", "en", "b", 25),
        (8, "same text here twice over", "en", "b", 25),
        (None, "no id at all", "fr", "b", 12),
        (None, "no id at all", "fr", "b", 12),
    ]
    clash = ["size", "shard", "score", "kept", "id", "n", "part", "host", "ids", "level", "cut", "root", "weight"]
    df = spark.createDataFrame(rows, DOC)
    for i, name in enumerate(clash):
        df = df.selectExpr("*", f"{i} AS {name}")
    return df


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOC)
