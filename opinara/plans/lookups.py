"""The five core queries and the lookup tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions.scalars import r6
from opinara.operators import lookups as L
from opinara.plans.registry import query
from opinara.sources.tables import with_views

TIE = ("l_orderkey", "l_linenumber", "item_id", "user_id", "rating")


@query(
    "product_info_batch",
    with_views("""SELECT item_id, title, main_category, store, price FROM products
                  WHERE item_id IN (SELECT item_id FROM reviews)"""),
)
def product_info_batch(t):
    return L.product_info(t.products, t.raw("lineitem").select(F.col("l_partkey").alias("item_id")))


@query(
    "recent_reviews_topn",
    with_views("""SELECT item_id, user_id, rating, ts, helpful_vote, verified_purchase, title, rank FROM (
                    SELECT *, CAST(row_number() OVER (PARTITION BY item_id
                       ORDER BY ts DESC, l_orderkey, l_linenumber, user_id, rating, helpful_vote,
                                verified_purchase, title) AS INT) AS rank
                    FROM reviews) WHERE rank <= 10"""),
)
def recent_reviews_topn(t):
    tie = ("l_orderkey", "l_linenumber", "user_id", "rating", "helpful_vote", "verified_purchase", "title")
    out = L.recent_reviews(t.reviews, 10, tie)
    return out.select("item_id", "user_id", "rating", "ts", "helpful_vote", "verified_purchase", "title", "rank")


@query(
    "user_history",
    with_views("""SELECT user_id, item_id, title, rating, ts, review_title, verified_purchase, rank FROM (
                    SELECT r.user_id, r.item_id, p.title, r.rating, r.ts, r.title AS review_title,
                      r.verified_purchase, CAST(row_number() OVER (PARTITION BY r.user_id
                       ORDER BY r.ts DESC, r.l_orderkey, r.l_linenumber, r.item_id, r.rating, r.verified_purchase,
                                r.title) AS INT) AS rank
                    FROM reviews r JOIN products p ON r.item_id = p.item_id) WHERE rank <= 50"""),
)
def user_history(t):
    tie = ("l_orderkey", "l_linenumber", "item_id", "rating", "verified_purchase", "review_title")
    out = L.user_history(t.reviews, t.products, 50, tie)
    return out.select("user_id", "item_id", "title", "rating", "ts", "review_title", "verified_purchase", "rank")


@query(
    "product_statistics",
    with_views("""SELECT item_id, count(*) AS total_reviews, round(avg(rating), 6) AS avg_rating,
                    round(stddev_samp(rating), 6) AS rating_std, round(stddev_pop(rating), 6) AS rating_std_pop,
                    count(*) FILTER (rating = 1) AS star_1, count(*) FILTER (rating = 2) AS star_2,
                    count(*) FILTER (rating = 3) AS star_3, count(*) FILTER (rating = 4) AS star_4,
                    count(*) FILTER (rating = 5) AS star_5,
                    count(*) FILTER (verified_purchase) AS verified_count,
                    round(avg(rating) FILTER (verified_purchase), 6) AS verified_avg_rating,
                    round(CAST(count(*) FILTER (rating = 1) AS DOUBLE) / count(*) * 100, 6) AS star_1_pct,
                    round(CAST(count(*) FILTER (rating = 2) AS DOUBLE) / count(*) * 100, 6) AS star_2_pct,
                    round(CAST(count(*) FILTER (rating = 3) AS DOUBLE) / count(*) * 100, 6) AS star_3_pct,
                    round(CAST(count(*) FILTER (rating = 4) AS DOUBLE) / count(*) * 100, 6) AS star_4_pct,
                    round(CAST(count(*) FILTER (rating = 5) AS DOUBLE) / count(*) * 100, 6) AS star_5_pct
                  FROM reviews GROUP BY item_id"""),
)
def product_statistics(t):
    return L.product_statistics(t.reviews)


@query(
    "user_lookup",
    with_views("""SELECT user_id, count(rating) AS review_count, round(avg(rating), 6) AS avg_rating,
                    count(DISTINCT item_id) AS unique_products, min(ts) AS first_review, max(ts) AS last_review
                  FROM reviews GROUP BY user_id"""),
)
def user_lookup(t):
    return L.user_lookup(t.reviews)


@query(
    "product_lookup",
    with_views("""SELECT item_id, count(rating) AS review_count, round(avg(rating), 6) AS avg_rating,
                    count(DISTINCT user_id) AS unique_users, CAST(sum(helpful_vote) AS BIGINT) AS total_helpful_votes
                  FROM reviews GROUP BY item_id"""),
)
def product_lookup(t):
    return L.product_lookup(t.reviews)


@query(
    "products_with_review_stats",
    with_views("""SELECT p.item_id, p.title, p.main_category, p.store, p.price,
                    round(s.a, 6) AS average_rating, coalesce(s.n, 0) AS rating_number
                  FROM products p LEFT JOIN (SELECT item_id, avg(rating) AS a, count(rating) AS n
                    FROM reviews GROUP BY item_id) s ON p.item_id = s.item_id"""),
)
def products_with_review_stats(t):
    return L.with_review_stats(t.products, t.reviews).withColumn("average_rating", r6("average_rating"))


@query(
    "fk_audit",
    """SELECT count(*) AS orphan_rows, count(DISTINCT l_orderkey) AS orphan_keys
       FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def fk_audit(t):
    parent = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return L.foreign_key_audit(t.raw("lineitem"), parent, "l_orderkey")


@query(
    "unique_key_audit",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def unique_key_audit(t):
    return L.key_violations(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "insert_ignore",
    """SELECT o_custkey AS c_custkey, min(o_orderkey) AS first_order FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""",
)
def insert_ignore(t):
    from opinara.sources.sinks import rows_to_insert

    target = t.raw("customer").filter("c_acctbal >= 0").select("c_custkey")
    new = t.raw("orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("first_order"))
    return rows_to_insert(new, target, ["c_custkey"], [F.asc("first_order")])
