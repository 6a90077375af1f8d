"""Exploratory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import scalars as S
from opinara.functions.scalars import r6
from opinara.operators import eda as E
from opinara.operators import toprows as TR
from opinara.operators.lookups import with_review_stats
from opinara.operators.quantiles import below_quantile, histogram
from opinara.plans.registry import query
from opinara.sources.tables import with_views

ORDER = ["ts", "l_orderkey", "l_linenumber", "item_id", "user_id", "rating", "helpful_vote"]


def _counts_sql(value: str, name: str, table: str = "reviews") -> str:
    return with_views(f"""SELECT {value} AS {name}, count(*) AS n,
        round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {table}) * 100, 6) AS pct FROM {table} GROUP BY {value}""")


@query("rating_distribution", _counts_sql("rating", "rating"))
def rating_distribution(t):
    return E.value_counts(t.reviews, F.col("rating"), "rating")


@query("verified_distribution", _counts_sql("verified_purchase", "verified_purchase"))
def verified_distribution(t):
    return E.value_counts(t.reviews, F.col("verified_purchase"), "verified_purchase")


@query("category_counts", _counts_sql("main_category", "main_category", "products"))
def category_counts(t):
    return E.value_counts(t.products, F.col("main_category"), "main_category")


@query("temporal_counts", with_views("""SELECT CAST(year(ts) AS INT) AS year, strftime(ts, '%b') AS month_name, count(*) AS n
    FROM reviews GROUP BY ALL"""))
def temporal_counts(t):
    return t.reviews.groupBy(F.year("ts").alias("year"), S.month_name("ts").alias("month_name")).agg(F.count(F.lit(1)).alias("n"))


@query("rating_by_year", with_views("""SELECT CAST(year(ts) AS INT) AS year, count(*) AS n, round(avg(rating), 6) AS avg_rating
    FROM reviews GROUP BY ALL"""))
def rating_by_year(t):
    return E.group_mean(t.reviews, F.year("ts"), "year")


@query("rating_by_verified", with_views("""SELECT verified_purchase, count(*) AS n, round(avg(rating), 6) AS avg_rating
    FROM reviews GROUP BY ALL"""))
def rating_by_verified(t):
    return E.group_mean(t.reviews, F.col("verified_purchase"), "verified_purchase")


@query("table_stats", with_views("""SELECT count(*) AS n_reviews, round(avg(rating), 6) AS mean_rating,
    CAST(median(rating) AS DOUBLE) AS median_rating, round(stddev_samp(rating), 6) AS std_rating, min(rating) AS min_rating,
    max(rating) AS max_rating, round(100 * CAST(count(*) FILTER (verified_purchase) AS DOUBLE) / count(*), 6) AS verified_pct,
    min(ts) AS first_review, max(ts) AS last_review FROM reviews"""))
def table_stats(t):
    return E.rating_summary(t.reviews)


@query("reviews_per_key", with_views("""WITH u AS (SELECT count(*) AS c FROM reviews GROUP BY user_id),
    i AS (SELECT count(*) AS c FROM reviews GROUP BY item_id)
    SELECT 'user' AS entity, count(*) AS n_keys, round(median(c), 6) AS median_reviews, round(avg(c), 6) AS mean_reviews,
      max(c) AS max_reviews FROM u
    UNION ALL SELECT 'product', count(*), round(median(c), 6), round(avg(c), 6), max(c) FROM i"""))
def reviews_per_key(t):
    u = E.counts_per_key(t.reviews, "user_id").withColumn("entity", F.lit("user"))
    return u.unionByName(E.counts_per_key(t.reviews, "item_id").withColumn("entity", F.lit("product")))


@query("kpi_summary", with_views("""WITH u AS (SELECT count(*) AS c FROM reviews GROUP BY user_id),
    i AS (SELECT count(*) AS c FROM reviews GROUP BY item_id)
    SELECT count(*) AS total_reviews, min(ts) AS first_review, max(ts) AS last_review, round(avg(rating), 6) AS mean_rating,
      count(*) FILTER (rating = 1) AS rating_1, count(*) FILTER (rating = 2) AS rating_2,
      count(*) FILTER (rating = 3) AS rating_3, count(*) FILTER (rating = 4) AS rating_4,
      count(*) FILTER (rating = 5) AS rating_5,
      round(100 * CAST(count(*) FILTER (verified_purchase) AS DOUBLE) / count(*), 6) AS verified_pct,
      round(avg(length(text)), 6) AS mean_text_length, count(*) FILTER (title IS NULL) AS missing_titles,
      count(*) FILTER (text IS NULL) AS missing_text, count(*) FILTER (helpful_vote = 0) AS zero_helpful,
      (SELECT count(*) FROM u) AS unique_users, (SELECT median(c) FROM u) AS median_reviews_per_user,
      (SELECT max(c) FROM u) AS most_active_user_reviews, (SELECT count(*) FROM i) AS unique_products,
      (SELECT median(c) FROM i) AS median_reviews_per_product, (SELECT max(c) FROM i) AS most_reviewed_product_reviews,
      CAST(median(length(text)) AS DOUBLE) AS median_text_length FROM reviews"""))
def kpi_summary(t):
    return E.kpi_summary(t.reviews)


@query("star_distribution_zero_filled", with_views("""SELECT p.item_id, s.star, count(r.rating) AS n FROM products p
    CROSS JOIN (SELECT CAST(unnest(range(1, 6)) AS INT) AS star) s
    LEFT JOIN reviews r ON r.item_id = p.item_id AND r.rating = s.star GROUP BY p.item_id, s.star"""))
def star_distribution_zero_filled(t):
    return E.star_distribution(t.products, t.reviews)


@query("star_median_mode", with_views("""WITH c AS (SELECT item_id, rating, count(*) AS n FROM reviews GROUP BY ALL)
    SELECT r.item_id, count(*) AS total_reviews, CAST(median(r.rating) AS DOUBLE) AS median_rating,
      (SELECT c.rating FROM c WHERE c.item_id = r.item_id ORDER BY c.n DESC, c.rating LIMIT 1) AS mode_rating
    FROM reviews r GROUP BY r.item_id"""))
def star_median_mode(t):
    return E.star_median_mode(t.reviews)


def _hist_sql(values: str, bins: int) -> str:
    return f"""WITH v AS ({values}), m AS (SELECT min(c) AS lo, max(c) AS hi, (max(c) - min(c)) / {bins} AS w FROM v),
      b AS (SELECT CAST(least(floor((c - lo) / w), {bins - 1}) AS INT) AS bin, count(*) AS n FROM v, m GROUP BY 1)
      SELECT g.bin, round(lo + g.bin * w, 6) AS bin_start, round(lo + (g.bin + 1) * w, 6) AS bin_end, coalesce(b.n, 0) AS n
      FROM (SELECT CAST(unnest(range({bins})) AS INT) AS bin) g LEFT JOIN b ON b.bin = g.bin, m"""


def _rounded(h):
    return h.withColumns({"bin_start": r6("bin_start"), "bin_end": r6("bin_end")})


@query("review_count_histogram", _hist_sql("SELECT CAST(count(*) AS DOUBLE) AS c FROM lineitem GROUP BY l_partkey", 50))
def review_count_histogram(t):
    per_item = t.raw("lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("c"))
    return _rounded(histogram(per_item, "c", 50))


@query("text_length_histogram", _hist_sql("SELECT CAST(length(text) AS DOUBLE) AS c FROM documents", 50))
def text_length_histogram(t):
    return _rounded(histogram(t.documents.select(F.length("text").alias("c")), "c", 50))


@query("price_trim_p95", """SELECT p_partkey AS item_id, p_retailprice AS price FROM part
    WHERE p_retailprice < (SELECT quantile_cont(p_retailprice, 0.95) FROM part)""")
def price_trim_p95(t):
    return below_quantile(t.products.select("item_id", "price"), "price", 0.95)


@query("price_summary", """WITH k AS (SELECT p_retailprice AS p FROM part
      WHERE p_retailprice < (SELECT quantile_cont(p_retailprice, 0.95) FROM part))
    SELECT count(*) AS n_products, round(avg(p), 6) AS mean_price, round(median(p), 6) AS median_price, min(p) AS min_price,
      max(p) AS max_price FROM k""")
def price_summary(t):
    return E.price_summary(t.products)


STATS_SQL = """WITH s AS (SELECT p.item_id, p.title, p.price, p.main_category, x.a AS average_rating, coalesce(x.n, 0) AS rating_number
    FROM products p LEFT JOIN (SELECT item_id, avg(rating) AS a, count(rating) AS n FROM reviews GROUP BY item_id) x
      ON x.item_id = p.item_id)"""
STATS_COLS = ["item_id", "title", "price", "main_category", "average_rating", "rating_number"]


def _stats(t):
    return with_review_stats(t.products, t.reviews).select(*STATS_COLS)


@query("top_rated_items", with_views(STATS_SQL + """ SELECT * REPLACE (round(average_rating, 6) AS average_rating) FROM s
    WHERE rating_number >= 20 AND average_rating >= 3.5 ORDER BY s.average_rating DESC, rating_number DESC, item_id LIMIT 10"""))
def top_rated_items(t):
    return E.highly_rated(_stats(t), min_reviews=20, min_rating=3.5).withColumn("average_rating", r6("average_rating"))


@query("eligible_items", with_views(STATS_SQL + """ SELECT item_id, rating_number FROM s
    WHERE rating_number >= 40 AND average_rating IS NOT NULL"""))
def eligible_items(t):
    return E.eligible_products(_stats(t), 40).select("item_id", "rating_number")


@query("multi_term_title_search", """SELECT p_partkey AS item_id, p_name AS title FROM part
    WHERE lower(p_name) LIKE '%red%' AND lower(p_name) LIKE '%widget%'""")
def multi_term_title_search(t):
    return E.title_has_all(t.products.select("item_id", "title"), ["Red", "WIDGET"])


@query("multi_term_title_fallback", """SELECT p_partkey AS item_id, p_name AS title FROM part WHERE lower(p_name) LIKE '%red%'""")
def multi_term_title_fallback(t):
    return E.title_has_all(t.products.select("item_id", "title"), ["red", "no such word"])


@query("top_active_users", with_views("SELECT user_id, count(*) AS n FROM reviews GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10"))
def top_active_users(t):
    return E.top_values(t.reviews, "user_id")


@query("top_stores", with_views("SELECT store, count(*) AS n FROM products GROUP BY store ORDER BY n DESC, store LIMIT 10"))
def top_stores(t):
    return E.top_values(t.products, "store")


@query("latest_reviews", with_views("""SELECT ts, user_id, item_id, rating, l_orderkey, l_linenumber FROM reviews
    ORDER BY ts DESC, l_orderkey, l_linenumber, user_id, item_id, rating LIMIT 20"""))
def latest_reviews(t):
    cols = ["ts", "user_id", "item_id", "rating", "l_orderkey", "l_linenumber"]
    tie = ["l_orderkey", "l_linenumber", "user_id", "item_id", "rating"]
    return TR.top_n(t.reviews.select(*cols), [F.desc("ts"), *[F.asc(c) for c in tie]], 20)


@query("temporal_split_counts", with_views("""WITH o AS (SELECT *, row_number() OVER (ORDER BY ts, l_orderkey, l_linenumber, item_id,
      user_id, rating, helpful_vote) - 1 AS pos, count(*) OVER () AS n FROM reviews)
    SELECT CASE WHEN pos < CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS part, count(*) AS n_reviews,
      min(ts) AS first_review, max(ts) AS last_review, CAST(sum(rating) AS BIGINT) AS rating_sum FROM o GROUP BY 1"""))
def temporal_split_counts(t):
    return TR.temporal_part(t.reviews, ORDER, 0.2).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.min("ts").alias("first_review"), F.max("ts").alias("last_review"),
        F.sum("rating").alias("rating_sum"),
    )


@query("user_halves", with_views("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, l_orderkey, l_linenumber,
      item_id, rating, helpful_vote) - 1 AS position, count(*) OVER (PARTITION BY user_id) AS n_reviews FROM reviews)
    SELECT user_id, item_id, rating, ts, l_orderkey, l_linenumber, position, n_reviews, position >= n_reviews // 2 AS is_later_half FROM o"""))
def user_halves(t):
    out = TR.user_halves(t.reviews, ["ts", "l_orderkey", "l_linenumber", "item_id", "rating", "helpful_vote"])
    return out.select("user_id", "item_id", "rating", "ts", "l_orderkey", "l_linenumber", "position", "n_reviews", "is_later_half")


@query("seeded_sample", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 500""")
def seeded_sample(t):
    return TR.seeded_sample(t.raw("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 500)


@query("sampled_users_rows", with_views("""SELECT user_id, item_id, rating FROM reviews WHERE user_id IN (
    SELECT user_id FROM (SELECT DISTINCT user_id FROM reviews) ORDER BY md5('42:' || user_id), user_id LIMIT 200)"""))
def sampled_users_rows(t):
    return TR.rows_of_sampled_keys(t.reviews, "user_id", 200).select("user_id", "item_id", "rating")


@query("scalar_functions", with_views("""SELECT user_id || '_' || item_id || '_' || epoch_ms(ts) AS review_id,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso_ts, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
      CASE WHEN length(text) > 5 THEN substring(text, 1, 5) || '...' ELSE text END AS short_text,
      CAST(least(helpful_vote, 5) AS DOUBLE) / 5 AS capped, round(1.0 / (1 + rating), 6) AS similarity,
      round((rating / 5.0 + 1) / 2, 6) AS unit_score FROM reviews"""))
def scalar_functions(t):
    return t.reviews.select(
        S.composite_key("user_id", "item_id", F.unix_millis("ts")).alias("review_id"),
        S.iso_timestamp("ts").alias("iso_ts"), F.year("ts").alias("year"), F.month("ts").alias("month"),
        S.ellipsis("text", 5).alias("short_text"), S.capped_ratio("helpful_vote", 5).alias("capped"),
        r6(S.distance_to_similarity("rating")).alias("similarity"), r6(S.cosine_to_unit(F.col("rating") / 5)).alias("unit_score"),
    )


@query("json_map_column", """SELECT event_id, 'k' AS first_key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_map_column(t):
    props = F.from_json("props", "map<string,string>")
    return t.raw("events").select(
        "event_id", F.element_at(F.map_keys(props), 1).alias("first_key"), F.element_at(props, "k").cast("long").alias("k")
    )
