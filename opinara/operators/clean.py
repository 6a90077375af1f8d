"""Raw JSON lines to clean review and product tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import scalars as S
from opinara.functions.text import clean_text
from opinara.operators.toprows import top_n_per_key

REVIEW_KEY = ("user_id", "item_id", "ts")


def valid_review() -> Column:
    """Rating within 1..5 and both keys non-empty (a missing value is invalid)."""
    key_ok = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    return F.coalesce(F.col("rating").between(1, 5), F.lit(False)) & key_ok("user_id") & key_ok("item_id")


def first_of_copies(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key. Copies are cut to one per map task before the shuffle."""
    return top_n_per_key(df, keys, order, 1, "_copy").drop("_copy")


def clean_reviews(raw: DataFrame, strip_latin1: bool = False) -> DataFrame:
    """Typed and cleaned review columns; no rows removed.

    `raw` has the raw record's fields, with `parent_asin` or `item_id` as product key.
    """
    item = "parent_asin" if "parent_asin" in raw.columns else "item_id"
    ts = S.parse_epoch_ms("timestamp")
    text = clean_text("text", strip_latin1)
    return raw.select(
        S.composite_key("user_id", item, "timestamp").alias("review_id"),
        "user_id",
        F.col(item).alias("item_id"),
        F.coalesce(F.col("rating").cast("double"), F.lit(0.0)).alias("rating"),
        clean_text("title", strip_latin1).alias("title"),
        text.alias("text"),
        F.length(text).alias("text_length"),
        S.list_not_empty("images").alias("has_image"),
        F.coalesce(F.col("helpful_vote").cast("int"), F.lit(0)).alias("helpful_vote"),
        F.coalesce(F.col("verified_purchase"), F.lit(False)).alias("verified_purchase"),
        ts.alias("ts"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
    )


def process_reviews(raw: DataFrame, order: list[Column] | None = None, strip_latin1: bool = False, compat: bool = False) -> DataFrame:
    """Clean, filter, and keep the earliest copy of each (user, product, time).

    With `compat` copies are removed before the quality filter, so an invalid
    first copy hides a later valid one. `order` decides which copy is first
    (column names of the cleaned table); default is the cleaned values.
    """
    order = order or [F.asc("rating"), F.asc("title"), F.asc("text"), F.desc("helpful_vote"), F.desc("verified_purchase")]
    rows = clean_reviews(raw, strip_latin1)
    if compat:
        return first_of_copies(rows, list(REVIEW_KEY), order).filter(valid_review())
    return first_of_copies(rows.filter(valid_review()), list(REVIEW_KEY), order)


def ingest_counters(raw: DataFrame, bad_lines: Column | None = None) -> DataFrame:
    """One row: raw lines, clean reviews, copies removed, rows dropped, unreadable lines.

    Rows combine per key in the map tasks, so a large group of copies costs one row per task.
    """
    bad = F.lit(False) if bad_lines is None else bad_lines
    flagged = raw.withColumn("_unread", bad)
    item = "parent_asin" if "parent_asin" in raw.columns else "item_id"
    keyed = flagged.select(
        "_unread",
        "user_id",
        F.col(item).alias("item_id"),
        F.col("timestamp").alias("ts"),
        F.coalesce(F.col("rating").cast("double"), F.lit(0.0)).alias("rating"),
    ).withColumn("_valid", valid_review() & ~F.col("_unread"))
    per_key = keyed.groupBy("user_id", "item_id", "ts").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_unread").alias("unread"),
        F.count_if("_valid").alias("valid"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return per_key.agg(
        zero(F.sum("n")).alias("raw_reviews"),
        zero(F.sum("unread")).alias("unreadable_lines"),
        zero(F.count_if(F.col("valid") > 0)).alias("cleaned_reviews"),
        zero(F.sum(F.greatest(F.col("valid") - 1, F.lit(0)))).alias("duplicates_removed"),
        zero(F.sum(F.col("n") - F.col("unread") - F.col("valid"))).alias("missing_dropped"),
    )


def process_metadata(raw: DataFrame, strip_latin1: bool = False) -> DataFrame:
    """Clean product rows from raw product records.

    A zero or missing `average_rating` becomes NULL, a missing `rating_number` 0.
    """
    have = set(raw.columns)
    strings = F.array().cast("array<string>")
    lists = [F.coalesce(F.col(c), strings).alias(c) for c in ("features", "categories", "bought_together")]
    details = [F.col("details")] if "details" in have else []
    rating = F.col("average_rating").cast("double")
    return raw.select(
        F.col("parent_asin").alias("item_id"),
        clean_text("title", strip_latin1).alias("title"),
        "main_category",
        F.when(rating != 0, rating).alias("average_rating"),
        F.coalesce(F.col("rating_number").cast("int"), F.lit(0)).alias("rating_number"),
        S.parse_price("price").alias("price"),
        S.price_is_suspect("price").alias("price_suspect"),
        "store",
        S.list_not_empty("images").alias("has_image"),
        S.list_not_empty("videos").alias("has_video"),
        clean_text(S.join_list("description"), strip_latin1).alias("description"),
        *lists,
        *details,
    )
