import gzip
import json

import pytest
from pyspark.sql import functions as F

from opinara.functions import scalars as S
from opinara.functions.text import bigrams, clean_text, tokens, without_stop_words
from opinara.operators import clean as C
from opinara.sources.jsonl import BAD, PRODUCT_SCHEMA, REVIEW_SCHEMA, read_jsonl

LINES = [
    {"user_id": "u1", "parent_asin": "p1", "timestamp": 1000, "rating": 5.0, "title": " Great\n<b>thing</b> ", "text": "café \u0001ok", "images": [{"a": "b"}], "helpful_vote": 2, "verified_purchase": True},
    {"user_id": "u1", "parent_asin": "p1", "timestamp": 1000, "rating": 5.0, "title": "copy", "text": None},
    {"user_id": "u2", "parent_asin": "p1", "timestamp": 2000, "rating": 0.0, "title": "", "text": "zero"},
    {"user_id": "u2", "parent_asin": "p1", "timestamp": 2000, "rating": 3.0, "title": "later copy", "text": "fine"},
    {"user_id": "u3", "parent_asin": "p2", "timestamp": 3000, "rating": 6.0},
    {"user_id": "", "parent_asin": "p2", "timestamp": 4000, "rating": 4.0},
    {"user_id": "u4", "parent_asin": "p2", "timestamp": 86400000, "rating": 1.0, "images": []},
]


@pytest.fixture
def review_file(tmp_path):
    path = tmp_path / "reviews.jsonl.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        for i, rec in enumerate(LINES):
            f.write(json.dumps(rec) + "\n")
            if i == 2:
                f.write("{broken\n")
    return str(path)


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_clean_text_steps(spark):
    assert one(spark, clean_text("t"), t="  a \t b c ") == "a b c"
    assert one(spark, clean_text("t"), t="a <i> b </i> c") == "a  b  c"
    assert one(spark, clean_text("t"), t="x\u0007y\u007f") == "xy"
    assert one(spark, clean_text("t"), t="café ł") == "café ł"
    assert one(spark, clean_text("t", strip_latin1=True), t="café ł") == "caf ł"
    assert one(spark, clean_text("t"), t=None) == ""


@pytest.mark.parametrize("text,value,suspect", [
    ("$1,299.00", 1299.0, False), ("$10 - $20", 1020.0, True), ("1.2.3", None, False), (None, None, False), ("12.5", 12.5, False), ("free", None, False),
])
def test_price(spark, text, value, suspect):
    assert one(spark, S.parse_price("p"), p=text) == value
    assert one(spark, S.price_is_suspect("p"), p=text) == suspect


def test_words(spark):
    row = spark.createDataFrame([("The Red-Hot café a b_1",)], "t string")
    words = row.select(tokens("t").alias("w")).first()["w"]
    assert words == ["the", "red", "hot", "café", "b_1"]
    kept = row.select(without_stop_words(tokens("t")).alias("w"))
    assert kept.select(bigrams(F.col("w")).alias("g")).first()["g"] == ["red hot", "hot café", "café b_1"]
    assert spark.createDataFrame([(["x"],)], "w array<string>").select(bigrams(F.col("w")).alias("g")).first()["g"] == []


def test_scalars(spark):
    assert one(spark, S.ellipsis("t", 3), t="abcd") == "abc..."
    assert one(spark, S.score_cell(F.col("t"), F.lit(0.834)), t="name") == "name (0.83)"
    assert one(spark, S.score_cell(F.col("t"), F.lit(0.834)), t=None) == "—"
    assert one(spark, S.nan_to_null(F.lit(float("nan"))), t="") is None
    assert one(spark, S.nan_to_null(F.lit(float("inf"))), t="") is None
    assert one(spark, S.nan_to_null(F.lit(1.5)), t="") == 1.5
    assert one(spark, S.percent(F.lit(1), F.lit(0)), t="") == 0.0
    assert one(spark, S.has_real_item(F.array(F.lit(""), F.lit("nan"))), t="") is False
    assert one(spark, S.has_real_item(F.array(F.lit("x"))), t="") is True
    assert one(spark, S.to_number("t"), t="no") is None
    assert 0 <= one(spark, S.hash_bucket("t"), t="Beauty") < 1


def test_read_modes(spark, review_file):
    assert read_jsonl(spark, review_file, REVIEW_SCHEMA).count() == 7
    kept = read_jsonl(spark, review_file, REVIEW_SCHEMA, "keep").cache()
    assert kept.filter(F.col(BAD).isNotNull()).count() == 1
    assert read_jsonl(spark, review_file, REVIEW_SCHEMA, limit=4).count() == 3
    with pytest.raises(Exception):
        read_jsonl(spark, review_file, REVIEW_SCHEMA, "fail").collect()


def test_process_reviews(spark, review_file):
    raw = read_jsonl(spark, review_file, REVIEW_SCHEMA)
    rows = {r["review_id"]: r for r in C.process_reviews(raw, [F.desc("title")]).collect()}
    assert set(rows) == {"u1_p1_1000", "u2_p1_2000", "u4_p2_86400000"}
    assert rows["u2_p1_2000"]["rating"] == 3.0
    assert rows["u4_p2_86400000"]["month"] == 1 and rows["u4_p2_86400000"]["has_image"] is False
    # Copies first: the invalid first copy hides the valid one.
    compat = C.process_reviews(raw, [F.asc("title")], compat=True)
    assert {r["review_id"] for r in compat.collect()} == {"u1_p1_1000", "u4_p2_86400000"}


def test_counters(spark, review_file):
    raw = read_jsonl(spark, review_file, REVIEW_SCHEMA, "keep")
    got = C.ingest_counters(raw, F.col(BAD).isNotNull()).first().asDict()
    assert got == {"raw_reviews": 8, "unreadable_lines": 1, "cleaned_reviews": 3, "duplicates_removed": 1, "missing_dropped": 3}


def test_metadata(spark, tmp_path):
    recs = [
        {"parent_asin": "p1", "title": "<b>A</b>", "average_rating": 4.5, "rating_number": 10, "price": "$1,299.00", "description": ["one", "two"], "images": [{}], "features": ["f"], "details": {"k": "v"}},
        {"parent_asin": "p2", "title": None, "average_rating": 0, "price": None, "description": [], "videos": []},
        {"parent_asin": "p3", "price": 12.5},
    ]
    path = tmp_path / "meta.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in recs))
    rows = {r["item_id"]: r for r in C.process_metadata(read_jsonl(spark, str(path), PRODUCT_SCHEMA, "fail")).collect()}
    assert rows["p1"]["title"] == "A" and rows["p1"]["description"] == "one two" and rows["p1"]["price"] == 1299.0
    assert rows["p1"]["has_image"] and rows["p1"]["details"] == {"k": "v"}
    assert rows["p2"]["title"] == "" and rows["p2"]["average_rating"] is None and rows["p2"]["rating_number"] == 0
    assert rows["p3"]["price"] == 12.5 and rows["p3"]["features"] == []
