"""Raw records to tables and tables to folders: parsing, product cleaning, typed loads read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import scalars as S
from opinara.operators import clean as C
from opinara.operators import eda as E
from opinara.operators import graph as G
from opinara.operators.lookups import with_review_stats
from opinara.plans.eda import STATS_SQL
from opinara.plans.graph import EDGES_SQL, _edges
from opinara.plans.registry import query
from opinara.session import intermediate_path, materialise
from opinara.sources import sinks
from opinara.sources.jsonl import BAD, bad_lines, numbered_lines, parse_lines
from opinara.sources.tables import with_views

EVENT_LINE = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
])

# Every event as a line of JSON; lines of `error` events lack their closing brace.
LINES_SQL = """l AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type = 'error' AS broken,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":' || props || CASE WHEN event_type = 'error' THEN '' ELSE '}' END AS line
  FROM events)"""


def _lines(t, *kept):
    end = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}"))
    return t.raw("events").select(*kept, F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"'), "event_type", F.lit('","props":'), "props", end).alias("value"))


@query("jsonl_parse", f"WITH {LINES_SQL} SELECT event_id, event_type, k FROM l WHERE NOT broken")
def jsonl_parse(t):
    return parse_lines(_lines(t), EVENT_LINE, "skip").select("event_id", "event_type", F.col("props.k").alias("k"))


@query("jsonl_bad_lines", f"WITH {LINES_SQL} SELECT line AS bad FROM l WHERE broken")
def jsonl_bad_lines(t):
    return parse_lines(_lines(t), EVENT_LINE, "keep").filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("bad"))


@query("jsonl_bad_positions", f"""WITH {LINES_SQL.replace("FROM events)", ", row_number() OVER (ORDER BY event_id) AS position FROM events)")}
    SELECT line AS bad, position FROM l WHERE broken""")
def jsonl_bad_positions(t):
    """Unreadable lines by file and number; the files hold the events in their order, so both make up a position among all lines."""
    path = intermediate_path(t.spark)
    _lines(t, "event_id").repartitionByRange(8, "event_id").sortWithinPartitions("event_id").select("value").write.text(path)
    counts = numbered_lines(t.spark, path).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    before = counts.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return bad_lines(t.spark, path, EVENT_LINE).join(before, "file").select(F.col(BAD).alias("bad"), (F.col("before") + F.col("line")).alias("position"))


# Parts as raw product records: lists from the words of the name, gaps in every kind of column.
RAW_PRODUCTS_SQL = """raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS parent_asin, '  <i>' || p_name || '</i>  ' || p_brand AS title, p_type AS main_category,
    CAST(p_size % 6 AS DOUBLE) AS average_rating, CASE WHEN p_size > 10 THEN p_size END AS rating_number,
    CASE WHEN p_size % 5 = 0 THEN 'from ' || p_type ELSE '$' || printf('%.2f', p_retailprice) END AS price, p_brand AS store,
    CASE WHEN p_size % 7 = 0 THEN ['nan', ''] WHEN p_size % 7 < 5 THEN string_split(p_name, ' ') END AS features,
    CASE WHEN p_size % 3 = 0 THEN NULL ELSE [p_name, '<b>' || p_type || '</b>'] END AS description,
    [p_type, p_brand] AS categories, p_size % 2 = 0 AS has_image, p_size % 4 = 1 AS has_video FROM part)"""


def _raw_products(t):
    size, strings = F.col("p_size"), "array<string>"
    link = lambda there: F.when(there, F.array(F.col("p_name"))).otherwise(F.array().cast(strings))
    return t.raw("part").select(
        F.col("p_partkey").cast("string").alias("parent_asin"),
        F.concat(F.lit("  <i>"), "p_name", F.lit("</i>  "), "p_brand").alias("title"),
        F.col("p_type").alias("main_category"),
        (size % 6).cast("double").alias("average_rating"),
        F.when(size > 10, size).alias("rating_number"),
        F.when(size % 5 == 0, F.concat(F.lit("from "), "p_type")).otherwise(F.format_string("$%.2f", "p_retailprice")).alias("price"),
        F.col("p_brand").alias("store"),
        F.when(size % 7 == 0, F.array(F.lit("nan"), F.lit(""))).when(size % 7 < 5, F.split("p_name", " ")).alias("features"),
        F.when(size % 3 != 0, F.array("p_name", F.concat(F.lit("<b>"), "p_type", F.lit("</b>")))).alias("description"),
        F.array("p_type", "p_brand").alias("categories"),
        F.lit(None).cast(strings).alias("bought_together"),
        link(size % 2 == 0).alias("images"),
        link(size % 4 == 1).alias("videos"),
    )


@query("clean_products", f"""WITH {RAW_PRODUCTS_SQL}
  SELECT parent_asin AS item_id, trim(regexp_replace(trim(regexp_replace(title, '\\s+', ' ', 'g')), '<[^>]+>', '', 'g')) AS title,
    main_category, nullif(average_rating, 0) AS average_rating, CAST(coalesce(rating_number, 0) AS INT) AS rating_number,
    TRY_CAST(nullif(regexp_replace(price, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price, store, has_image, has_video,
    trim(regexp_replace(coalesce(array_to_string(description, ' '), ''), '<[^>]+>', '', 'g')) AS description,
    coalesce(array_to_string(features, '|'), '') AS features, array_to_string(categories, '|') AS categories, '' AS bought_together,
    coalesce(len(list_filter(features, lambda x: x NOT IN ('', 'nan', 'None'))) > 0, false) AS has_features,
    TRY_CAST(price[2:] AS DOUBLE) AS listed_price FROM raw""")
def clean_products(t):
    raw = _raw_products(t)
    lists = {c: S.join_list(c, "|") for c in ("features", "categories", "bought_together")}
    listed = raw.select(F.col("parent_asin").alias("item_id"), S.to_number(F.substring("price", 2, 100)).alias("listed_price"))
    cleaned = C.process_metadata(raw).drop("price_suspect").withColumn("has_features", S.has_real_item("features")).withColumns(lists)
    return cleaned.join(listed, "item_id")


# Decimals of two digits, halves up, from whole numbers: the loads round exact ratios.
RATIO_SQL = "CAST((200 * {sum} + {n}) // (2 * {n}) AS DOUBLE) / 100"


@query("relational_products", with_views(STATS_SQL.replace("x.a AS average_rating", "x.a AS average_rating, x.s").replace(
    "avg(rating) AS a", "avg(rating) AS a, CAST(sum(rating) AS BIGINT) AS s").replace("p.main_category", "p.main_category, p.store") + f"""
    SELECT item_id, title, '' AS description, main_category, {RATIO_SQL.format(sum='s', n='rating_number')} AS average_rating,
      CAST(rating_number AS INT) AS rating_number, round(price, 2) AS price, store, '["' || replace(title, ' ', '","') || '"]' AS features FROM s"""))
def relational_products(t):
    products = with_review_stats(t.products, t.reviews).withColumn("features", F.split("title", " "))
    out = sinks.relational_products(products).drop("created_at")  # the clock differs between runs
    return out.withColumns({c: F.col(c).cast("double") for c in ("average_rating", "price")})


@query("relational_reviews", with_views("""SELECT user_id, item_id, rating, title AS review_title, text AS review_text,
    CAST(helpful_vote AS INT) AS helpful_vote, verified_purchase, ts AS review_timestamp, CAST(length(text) AS INT) AS text_length,
    CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM reviews WHERE item_id IN (SELECT item_id FROM products)"""))
def relational_reviews(t):
    # the row id is an xxhash64 of the key, which other engines lack
    return sinks.relational_reviews(t.reviews, t.products).drop("review_id").withColumn("rating", F.col("rating").cast("int"))


@query("relational_users", with_views(f"""SELECT user_id, CAST(count(*) AS INT) AS review_count,
    {RATIO_SQL.format(sum='CAST(sum(rating) AS BIGINT)', n='count(*)')} AS avg_rating, min(ts) AS first_review_date, max(ts) AS last_review_date
    FROM reviews GROUP BY user_id"""))
def relational_users(t):
    return sinks.relational_users(t.reviews).withColumn("avg_rating", F.col("avg_rating").cast("double"))


@query("load_years", with_views("""SELECT CAST(year(ts) AS INT) AS year, count(*) AS n, CAST(sum(rating) AS BIGINT) AS rating_sum,
    count(DISTINCT (user_id, item_id, ts)) AS row_ids FROM reviews WHERE item_id IN (SELECT item_id FROM products) GROUP BY ALL"""))
def load_years(t):
    """The relational load written by year and read back; row ids are unique per (user, product, time)."""
    path = intermediate_path(t.spark, "relational")
    sinks.load_relational(t.reviews, with_review_stats(t.products, t.reviews), path)
    years = t.spark.read.parquet(f"{path}/reviews").groupBy("year")
    return years.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rating").cast("long")).alias("rating_sum"), F.countDistinct("review_id").alias("row_ids"))


@query("refreshed_years", with_views("""SELECT CAST(year(ts) AS INT) AS year, count(*) AS old_rows,
      count(*) FILTER (rating >= 3 OR year(ts) >= 1997) AS new_rows,
      CAST(sum(CASE WHEN year(ts) >= 1997 THEN 10 * rating WHEN rating >= 3 THEN rating END) AS BIGINT) AS rating_sum
    FROM reviews GROUP BY ALL HAVING count(*) FILTER (rating >= 3 OR year(ts) >= 1997) > 0"""))
def refreshed_years(t):
    """A table by year, replaced as a whole from its own rows, then in its latest years only; an empty replacement is refused."""
    path = intermediate_path(t.spark, "refresh")
    rows = t.reviews.select("user_id", "item_id", "rating", F.year("ts").alias("year"))
    sinks.full_refresh(rows, path, ["year"])
    table = lambda: t.spark.read.schema(rows.schema).parquet(path)
    old = materialise(table().groupBy("year").agg(F.count(F.lit(1)).alias("old_rows")))
    sinks.full_refresh(table().filter("rating >= 3"), path, ["year"])
    try:
        sinks.full_refresh(table().filter("rating > 5"), path, ["year"])
    except ValueError:
        sinks.refresh_partitions(rows.filter("year >= 1997").withColumn("rating", F.col("rating") * 10), path, ["year"])
    new = table().groupBy("year").agg(F.count(F.lit(1)).alias("new_rows"), F.sum(F.col("rating").cast("long")).alias("rating_sum"))
    return new.join(old, "year").select("year", "old_rows", "new_rows", "rating_sum")


@query("load_document_users", with_views("""SELECT user_id, count(rating) AS review_count, round(avg(rating), 6) AS avg_rating,
    count(DISTINCT item_id) AS unique_products FROM reviews WHERE item_id IN (SELECT item_id FROM products) GROUP BY user_id"""))
def load_document_users(t):
    """The document load written as JSON and read back."""
    path = intermediate_path(t.spark, "documents")
    sinks.load_documents(t.reviews, t.products, path)
    schema = "user_id long, review_count long, avg_rating double, unique_products long"
    return t.spark.read.schema(schema).json(f"{path}/users")


@query("load_graph", with_views(f"""WITH {EDGES_SQL} SELECT src, dst, frequency FROM e"""))
def load_graph(t):
    """The graph load written and read back: its co-purchase edges."""
    path = intermediate_path(t.spark, "graph")
    g = G.property_graph(t.products, t.reviews, _edges(t))
    edges = {k: v for k, v in g.items() if k in ("reviewed", "bought_together")}
    sinks.load_graph({k: v for k, v in g.items() if k not in edges}, edges, path)
    return t.spark.read.parquet(f"{path}/bought_together").select("src", "dst", "frequency")


@query("csv_products", "SELECT p_partkey AS item_id, p_name AS title, p_type AS main_category, p_brand AS store, p_retailprice AS price FROM part")
def csv_products(t):
    """The products written as CSV and read back."""
    path = intermediate_path(t.spark, "csv")
    sinks.write_csv(t.products, path)
    return t.spark.read.option("header", True).schema(t.products.schema).csv(path)


@query("report_lines", with_views("""WITH x AS (SELECT count(*) AS n, count(DISTINCT user_id) AS u, count(DISTINCT item_id) AS i, min(rating) AS lo,
    max(rating) AS hi FROM reviews)
  SELECT 'n_reviews: ' || n AS value FROM x UNION ALL SELECT 'min_rating: ' || lo FROM x UNION ALL SELECT 'max_rating: ' || hi FROM x
  UNION ALL SELECT 'unique_users: ' || u FROM x UNION ALL SELECT 'unique_products: ' || i FROM x"""))
def report_lines(t):
    """Whole numbers of the summaries as a text report, written and read back."""
    path = intermediate_path(t.spark, "report")
    parts = E.rating_summary(t.reviews).select("n_reviews", "min_rating", "max_rating"), E.kpi_summary(t.reviews).select("unique_users", "unique_products")
    sinks.write_report(E.summary_report_lines(parts[0]).union(E.summary_report_lines(parts[1])), path)
    return t.spark.read.text(path)
