import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
CLASHES = ("size", "slot", "shard", "score", "lang_pred", "k", "n", "bands", "target", "taken", "weight", "block", "part", "text_key", "id_", "leak_id_", "sort_key")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark_items(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text, lang, source): nulls, blanks, ties, repeats, a long text, a hot group of copies."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    story = " ".join(f"word{i} goes" for i in range(40))
    rows = [
        (1, story, "en", "a"), (2, story, "en", "a"), (2, story, "en", "a"), (3, story + " and ends", None, "b"), (4, story.upper(), "en", None),
        (5, None, None, None), (6, "", "de", "b"), (7, " \t\n\x0b\x0c\r ", "de", "b"), (8, "one", "de", "c"), (9, "one", "de", "c"),
        (10, "a b c d", "fr", "c"), (11, "a b c d", "fr", "c"), (12, long, "en", "d"), (13, long + " tail", "en", "d"), (None, story, "en", "a"), (None, None, None, "e"),
        (14, "x y " * 60, "en", "f"), (15, "été naïve 中文 \U0001f600   z z", "fr", "g"), (-5, "12 34 !!", "en", "g"), (1 << 62, story, "en", "a"),
    ]
    return rows + [(100 + i, "hot copy of one text that many rows share, every word the same in each of them. " * 3, "en", "hot") for i in range(30)]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The edge rows with extra columns whose names operators use themselves."""
    df = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string").repartition(3)
    return df.select("*", F.length("text").cast("long").alias("n_chars"), *(F.lit(c).alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def sf():
    assert os.path.isdir(SF)
    return SF
