"""The star-schema test tables, seen as products, reviews and users.

`SQL_VIEWS` states the same mapping for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Lazily opened tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Timestamps in the files carry no zone; results are compared in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("main_category"),
            F.col("p_brand").alias("store"),
            F.col("p_retailprice").alias("price"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """One row per order line: the buyer rates the part, 1 to 5."""
        lines = self.raw("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_partkey").alias("item_id"),
            F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"),
            (F.col("l_returnflag") != "R").alias("verified_purchase"),
            F.col("l_linenumber").alias("helpful_vote"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
            F.col("l_linestatus").alias("title"),
        )
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderpriority").alias("text"),
        )
        return lines.join(orders, "l_orderkey")

    @cached_property
    def users(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")
        )

    @cached_property
    def documents(self) -> DataFrame:
        return self.raw("documents")

    @cached_property
    def ratings(self) -> DataFrame:
        from opinara.operators.recommend import rating_matrix

        return rating_matrix(self.reviews)

    @cached_property
    def written_ratings(self) -> DataFrame:
        """`ratings`, joined and grouped once for all uses."""
        from opinara.session import materialise

        return materialise(self.ratings)


SQL_VIEWS = """
products AS (
  SELECT p_partkey AS item_id, p_name AS title, p_type AS main_category, p_brand AS store,
         p_retailprice AS price FROM part),
reviews AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(ceil(l_quantity / 10) AS INT) AS rating,
         l_returnflag <> 'R' AS verified_purchase, l_linenumber AS helpful_vote,
         l_shipdate AS ts, l_linestatus AS title, o_orderpriority AS text,
         l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
users AS (SELECT c_custkey AS user_id, c_name AS name FROM customer),
ratings AS (
  SELECT user_id, item_id, CAST(sum(rating) AS DOUBLE) / count(*) AS rating
  FROM reviews GROUP BY user_id, item_id)
"""


def with_views(body: str) -> str:
    """Oracle SQL with the views in front; `body` may open with more CTEs."""
    text = body.strip()
    if text[:5].upper() == "WITH ":
        return f"WITH {SQL_VIEWS}, {text[5:]}"
    return f"WITH {SQL_VIEWS} {text}"
