"""Table writers and load rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.scalars import nan_to_null, surrogate_key
from opinara.operators.lookups import only_valid_references, user_lookup


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Snappy Parquet; `partition_by=["year"]` gives an open-ended yearly layout."""
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None, valid: Callable[[DataFrame], bool] | None = None) -> None:
    """Replace the Parquet table at `path` by `df`, or leave it as it is.

    The new table is written beside the old one, read back, checked (`valid`; by default it must have rows) and put in place by
    renaming. `df` may read the old table. A failed write or check leaves the old table alone and raises.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    stage, old = f"{path}.stage-{name}", f"{path}.old-{name}"
    at = {x: spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, stage, old)}
    fs = at[path].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write_parquet(df, stage, partition_by)
        fresh = spark.read.schema(df.schema).parquet(stage)
        if not (valid or (lambda t: not t.isEmpty()))(fresh):
            raise ValueError(f"the new table for {path} did not pass its check")
        there = fs.exists(at[path])
        if there and not fs.rename(at[path], at[old]):
            raise OSError(f"cannot move {path} away")
        if not fs.rename(at[stage], at[path]):
            if there:
                fs.rename(at[old], at[path])
            raise OSError(f"cannot put the new table at {path}")
    finally:
        fs.delete(at[stage], True)
    fs.delete(at[old], True)


def refresh_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that `df` has rows for; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; nested structs, arrays and maps stay nested."""
    df.write.mode("overwrite").json(path)


def write_report(lines: DataFrame, path: str) -> None:
    """A text report from a one-column (`value`) table."""
    lines.select(F.col("value").cast("string")).write.mode("overwrite").text(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to an external table, 10,000 rows per round trip from every partition."""
    df.write.mode("append").option("batchsize", 10_000).jdbc(url, table, properties=properties or {})


def rows_to_insert(new: DataFrame, target: DataFrame, keys: list[str], prefer: list[Column] | None = None) -> DataFrame:
    """Insert-ignore: one new row per key that the target lacks.

    With `prefer` the first row in that order is kept, otherwise any. The row is
    picked by an aggregate, so repeats of a hot key combine before the shuffle.
    """
    fresh = new.join(target.select(*keys), keys, "left_anti")
    if prefer is None:
        return fresh.dropDuplicates(keys)
    from opinara.operators.toprows import top_n_per_key

    return top_n_per_key(fresh, keys, prefer, 1, "_n").drop("_n")


def merge_counts(old: DataFrame, new: DataFrame, keys: list[str], count: str = "frequency") -> DataFrame:
    """Upsert with a counter: add the new occurrences to the stored ones."""
    return old.select(*keys, count).unionByName(new.select(*keys, count)).groupBy(*keys).agg(F.sum(count).alias(count))


def distinct_vertices(edges: DataFrame, key: str) -> DataFrame:
    """Get-or-create of vertices: each key once."""
    return edges.select(key).distinct()


def relational_products(products: DataFrame) -> DataFrame:
    """Typed, defaulted product rows; list and map columns as JSON text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    as_json = lambda c: F.coalesce(F.to_json(F.col(c)), F.lit("{}"))
    have = set(products.columns)
    nested = [as_json(c).alias(c) for c in ("features", "categories", "details", "bought_together") if c in have]
    return products.select(
        F.col("item_id"),
        text("title").alias("title"),
        (text("description") if "description" in have else F.lit("")).alias("description"),
        text("main_category").alias("main_category"),
        nan_to_null(F.col("average_rating").cast("double")).cast("decimal(3,2)").alias("average_rating"),
        F.coalesce(F.col("rating_number").cast("int"), F.lit(0)).alias("rating_number"),
        nan_to_null(F.col("price").cast("double")).cast("decimal(10,2)").alias("price"),
        text("store").alias("store"),
        *nested,
        F.current_timestamp().alias("created_at"),
    )


def relational_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Typed review rows of known products, with a surrogate id and year/month columns."""
    known = only_valid_references(reviews, products, "item_id").filter(F.col("rating").between(1, 5))
    return known.select(
        surrogate_key("user_id", "item_id", "ts").alias("review_id"),
        "user_id",
        "item_id",
        F.col("rating").cast("short").alias("rating"),
        F.coalesce("title", F.lit("")).alias("review_title"),
        F.coalesce("text", F.lit("")).alias("review_text"),
        F.coalesce(F.col("helpful_vote").cast("int"), F.lit(0)).alias("helpful_vote"),
        F.coalesce("verified_purchase", F.lit(False)).alias("verified_purchase"),
        F.col("ts").alias("review_timestamp"),
        F.coalesce(F.length("text"), F.lit(0)).alias("text_length"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
    )


def relational_users(reviews: DataFrame) -> DataFrame:
    u = user_lookup(reviews)
    return u.select(
        "user_id",
        F.col("review_count").cast("int").alias("review_count"),
        F.col("avg_rating").cast("decimal(3,2)").alias("avg_rating"),
        F.col("first_review").alias("first_review_date"),
        F.col("last_review").alias("last_review_date"),
    )


def load_relational(reviews: DataFrame, products: DataFrame, folder: str) -> None:
    """Full refresh of the products, users and reviews tables (reviews by year)."""
    write_parquet(relational_products(products), f"{folder}/products")
    kept = only_valid_references(reviews, products, "item_id")
    write_parquet(relational_users(kept), f"{folder}/users")
    write_parquet(relational_reviews(reviews, products), f"{folder}/reviews", ["year"])


def load_documents(reviews: DataFrame, products: DataFrame, folder: str) -> None:
    """Full refresh of nested JSON collections; users are computed from the reviews kept."""
    kept = only_valid_references(reviews, products, "item_id")
    write_json(products, f"{folder}/products")
    write_json(kept, f"{folder}/reviews")
    write_json(user_lookup(kept), f"{folder}/users")


def load_graph(vertices: dict[str, DataFrame], edges: dict[str, DataFrame], folder: str) -> None:
    """Full refresh of vertex and edge tables."""
    for name, df in {**vertices, **edges}.items():
        write_parquet(df, f"{folder}/{name}")
