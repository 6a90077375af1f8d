"""The five lookup queries and the per-user and per-product tables, for all keys at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.scalars import percent, r6
from opinara.operators.toprows import top_n_per_key


def product_info(products: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Product rows, of the given `item_id` keys or of all products."""
    return products if keys is None else products.join(keys.select("item_id"), "item_id", "left_semi")


def recent_reviews(reviews: DataFrame, n: int = 10, tie: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Latest `n` reviews of each product."""
    order = [F.desc("ts"), *[F.asc(c) for c in tie]]
    return top_n_per_key(reviews, ["item_id"], order, n)


def user_history(reviews: DataFrame, products: DataFrame, limit: int = 50, tie: tuple[str, ...] = ("item_id",)) -> DataFrame:
    """Latest `limit` reviews of each user with the product title.

    Products are joined first, so a review of an unknown product takes no place.
    """
    titled = reviews.withColumnRenamed("title", "review_title").join(
        products.select("item_id", F.col("title")), "item_id"
    )
    return top_n_per_key(titled, ["user_id"], [F.desc("ts"), *[F.asc(c) for c in tie]], limit)


def product_statistics(reviews: DataFrame) -> DataFrame:
    """Counts, mean, both deviations, star breakdown and verified figures per product.

    One shuffle: every column is a partial aggregate of the same grouping.
    """
    star = F.col("rating")
    verified = F.col("verified_purchase")
    counts = [F.count_if(star == s).alias(f"star_{s}") for s in range(1, 6)]
    grouped = reviews.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        r6(F.avg(star)).alias("avg_rating"),
        r6(F.stddev_samp(star)).alias("rating_std"),
        r6(F.stddev_pop(star)).alias("rating_std_pop"),
        *counts,
        F.count_if(verified).alias("verified_count"),
        r6(F.avg(F.when(verified, star))).alias("verified_avg_rating"),
    )
    shares = {f"star_{s}_pct": r6(percent(f"star_{s}", "total_reviews")) for s in range(1, 6)}
    return grouped.withColumns(shares)


def user_lookup(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("user_id").agg(
        F.count("rating").alias("review_count"),
        r6(F.avg("rating")).alias("avg_rating"),
        F.countDistinct("item_id").alias("unique_products"),
        F.min("ts").alias("first_review"),
        F.max("ts").alias("last_review"),
    )


def product_lookup(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("item_id").agg(
        F.count("rating").alias("review_count"),
        r6(F.avg("rating")).alias("avg_rating"),
        F.countDistinct("user_id").alias("unique_users"),
        F.sum("helpful_vote").alias("total_helpful_votes"),
    )


def with_review_stats(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Products with `average_rating` and `rating_number` from their reviews."""
    stats = reviews.groupBy("item_id").agg(
        F.avg("rating").alias("average_rating"), F.count("rating").alias("rating_number")
    )
    return products.join(stats, "item_id", "left").withColumn(
        "rating_number", F.coalesce("rating_number", F.lit(0))
    )


def foreign_key_audit(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """How many rows and distinct keys of `child` point at no parent."""
    orphans = child.join(parent.select(key), key, "left_anti")
    return orphans.agg(
        F.count(F.lit(1)).alias("orphan_rows"), F.countDistinct(key).alias("orphan_keys")
    )


def only_valid_references(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_semi")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
