"""Exploratory tables: counts, means, distributions, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.scalars import percent, r6
from opinara.operators.quantiles import exact_quantiles


def value_counts(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows per distinct value with their share in percent.

    The total is the sum of the same counts: one row per distinct value passes one task.
    """
    counts = df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", r6(percent("n", F.sum("n").over(Window.partitionBy()))))


def group_mean(df: DataFrame, by: Column, name: str, value: str = "rating") -> DataFrame:
    return df.groupBy(by.alias(name)).agg(F.count(F.lit(1)).alias("n"), r6(F.avg(value)).alias(f"avg_{value}"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The `n` most frequent values, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(n)


def star_distribution(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Five rows per product, stars without reviews as 0."""
    stars = reviews.groupBy("item_id").agg(*[F.count_if(F.col("rating") == s).alias(f"s{s}") for s in range(1, 6)])
    every = products.select("item_id").join(stars, "item_id", "left")
    cells = [F.struct(F.lit(s).alias("star"), F.coalesce(f"s{s}", F.lit(0)).alias("n")) for s in range(1, 6)]
    return every.select("item_id", F.inline(F.array(*cells)))


def star_median_mode(reviews: DataFrame) -> DataFrame:
    """Median and most frequent star per product from its five counts.

    The median averages the two middle reviews; the lowest star wins a tied mode.
    """
    stars = [F.count_if(F.col("rating") == s).alias(f"s{s}") for s in range(1, 6)]
    g = reviews.groupBy("item_id").agg(F.count("rating").alias("n"), *stars)
    running = [reduce(lambda a, b: a + b, [F.col(f"s{i}") for i in range(1, s + 1)]) for s in range(1, 6)]

    def star_at(position: Column) -> Column:
        out = F.lit(None).cast("int")
        for s in range(5, 0, -1):
            out = F.when(running[s - 1] > position, F.lit(s)).otherwise(out)
        return out

    low, high = star_at(F.floor((F.col("n") - 1) / 2)), star_at(F.floor(F.col("n") / 2))
    best = F.greatest(*[F.col(f"s{s}") for s in range(1, 6)])
    mode = F.lit(None).cast("int")
    for s in range(5, 0, -1):
        mode = F.when(F.col(f"s{s}") == best, F.lit(s)).otherwise(mode)
    return g.select("item_id", F.col("n").alias("total_reviews"), ((low + high) / 2).alias("median_rating"), mode.alias("mode_rating"))


def highly_rated(products: DataFrame, min_reviews: int = 50, top_n: int = 10, min_rating: float = 4.5) -> DataFrame:
    """Best products with enough reviews: rating, then review count, then id."""
    good = products.filter((F.col("rating_number") >= min_reviews) & (F.col("average_rating") >= min_rating))
    return good.orderBy(F.desc("average_rating"), F.desc("rating_number"), F.asc("item_id")).limit(top_n)


def eligible_products(products: DataFrame, min_reviews: int = 50) -> DataFrame:
    return products.filter((F.col("rating_number") >= min_reviews) & F.col("average_rating").isNotNull())


def title_has_all(products: DataFrame, terms: list[str]) -> DataFrame:
    """Products whose title contains every term, any case; the first term alone if none does."""
    has = lambda t: F.coalesce(F.lower(F.col("title")).contains(t.lower()), F.lit(False))
    every = products.filter(reduce(lambda a, b: a & b, [has(t) for t in terms]))
    return products.filter(has(terms[0])) if every.isEmpty() else every


def contains_text(df: DataFrame, keyword: str, columns: list[str]) -> DataFrame:
    """Case-sensitive substring in any of the columns."""
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(F.col(c).contains(keyword), F.lit(False)) for c in columns]))


def rating_summary(reviews: DataFrame) -> DataFrame:
    """One row over all reviews. Ratings have few distinct values, so the exact median is cheap."""
    return reviews.agg(
        F.count(F.lit(1)).alias("n_reviews"),
        r6(F.avg("rating")).alias("mean_rating"),
        r6(F.percentile("rating", F.lit(0.5))).alias("median_rating"),
        r6(F.stddev_samp("rating")).alias("std_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        r6(F.avg(F.col("verified_purchase").cast("double")) * 100).alias("verified_pct"),
        F.min("ts").alias("first_review"),
        F.max("ts").alias("last_review"),
    )


def counts_per_key(reviews: DataFrame, key: str) -> DataFrame:
    """One row: keys, median, mean and maximum of the number of reviews per key.

    Keys with equal counts combine first, so the median sees one row per count.
    """
    per_key = reviews.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    freq = per_key.groupBy("c").agg(F.count(F.lit(1)).alias("f"))
    return freq.agg(
        F.coalesce(F.sum("f"), F.lit(0)).alias("n_keys"),
        r6(F.percentile("c", F.lit(0.5), F.col("f"))).alias("median_reviews"),
        r6(F.sum(F.col("c") * F.col("f")) / F.sum("f")).alias("mean_reviews"),
        F.max("c").alias("max_reviews"),
    )


def price_summary(products: DataFrame, trim: float = 0.95) -> DataFrame:
    """Mean, median, min and max of prices below the `trim` quantile."""
    (cut,) = exact_quantiles(products, F.col("price"), [trim])
    kept = products.filter(F.col("price") < F.lit(cut))
    (median,) = exact_quantiles(kept, F.col("price"), [0.5])
    return kept.agg(
        F.count("price").alias("n_products"), r6(F.avg("price")).alias("mean_price"),
        r6(F.lit(median)).alias("median_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
    )


def kpi_summary(reviews: DataFrame) -> DataFrame:
    """The one-row summary report: totals, dates, rating distribution, medians, quality flags."""
    rating_n = [F.count_if(F.col("rating") == s).alias(f"rating_{s}") for s in range(1, 6)]
    length = F.length("text")
    missing = lambda c: F.count_if(F.col(c).isNull())
    base = reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.min("ts").alias("first_review"),
        F.max("ts").alias("last_review"),
        r6(F.avg("rating")).alias("mean_rating"),
        *rating_n,
        r6(F.avg(F.col("verified_purchase").cast("double")) * 100).alias("verified_pct"),
        r6(F.avg(length)).alias("mean_text_length"),
        missing("title").alias("missing_titles"),
        missing("text").alias("missing_text"),
        F.count_if(F.col("helpful_vote") == 0).alias("zero_helpful"),
    )
    lengths = reviews.filter(length.isNotNull()).groupBy(length.alias("c")).agg(F.count(F.lit(1)).alias("f"))
    per_user, per_item = counts_per_key(reviews, "user_id"), counts_per_key(reviews, "item_id")
    scalar = lambda df, c: df.select(c).scalar()
    return base.select(
        "*",
        scalar(per_user, "n_keys").alias("unique_users"),
        scalar(per_user, "median_reviews").alias("median_reviews_per_user"),
        scalar(per_user, "max_reviews").alias("most_active_user_reviews"),
        scalar(per_item, "n_keys").alias("unique_products"),
        scalar(per_item, "median_reviews").alias("median_reviews_per_product"),
        scalar(per_item, "max_reviews").alias("most_reviewed_product_reviews"),
        lengths.agg(r6(F.percentile("c", F.lit(0.5), F.col("f"))).alias("m")).scalar().alias("median_text_length"),
    )


def summary_report_lines(summary: DataFrame) -> DataFrame:
    """`name: value` text lines of a one-row summary, for `write_report`."""
    cells = F.array(*[F.concat_ws(": ", F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in summary.columns])
    return summary.select(F.explode(cells).alias("value"))
