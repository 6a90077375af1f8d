"""Cleaning, deduplication, profiles and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import scalars as S
from opinara.functions.text import clean_text
from opinara.operators import clean as C
from opinara.operators import profile as P
from opinara.plans.registry import query

# The cleaning rule in the oracle's regex dialect.
SQL_CLEAN = r"""trim(regexp_replace(regexp_replace(trim(regexp_replace(coalesce({c}, ''),
 '[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g')),
 '<[^>]+>', '', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f{latin}]', '', 'g'))"""


def sql_clean(c: str, latin1: bool = False) -> str:
    return SQL_CLEAN.format(c=c, latin=r"-\x{ff}" if latin1 else "")


@query("clean_text_documents", f"SELECT doc_id, {sql_clean('text')} AS text, length({sql_clean('text')}) AS text_length FROM documents")
def clean_text_documents(t):
    text = clean_text("text")
    return t.documents.select("doc_id", text.alias("text"), F.length(text).cast("long").alias("text_length"))


@query("clean_text_pages", f"SELECT page_id, {sql_clean('html', True)} AS text FROM pages")
def clean_text_pages(t):
    return t.raw("pages").select("page_id", clean_text("html", strip_latin1=True).alias("text"))


# Order lines as raw review records: quantities above 25 stand outside the 1..5 scale,
# and (order, line number) stands for the repeated (user, product, time) key.
RAW_SQL = """raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_linenumber AS VARCHAR) AS item_id,
         CAST(l_linenumber AS BIGINT) * 86400000 AS timestamp, CAST(floor(l_quantity / 5) AS DOUBLE) AS rating,
         '  <b>' || l_returnflag || '</b>  ' || l_linestatus AS title, 'part <i>' || l_partkey || '</i>' AS text,
         l_suppkey AS helpful_vote, l_returnflag <> 'R' AS verified_purchase FROM lineitem)"""


def raw_reviews(t):
    li = t.raw("lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("user_id"),
        F.col("l_linenumber").cast("string").alias("item_id"),
        (F.col("l_linenumber").cast("long") * 86400000).alias("timestamp"),
        F.floor(F.col("l_quantity") / 5).cast("double").alias("rating"),
        F.concat(F.lit("  <b>"), "l_returnflag", F.lit("</b>  "), "l_linestatus").alias("title"),
        F.concat(F.lit("part <i>"), F.col("l_partkey").cast("string"), F.lit("</i>")).alias("text"),
        F.array().cast("array<string>").alias("images"),
        F.col("l_suppkey").alias("helpful_vote"),
        (F.col("l_returnflag") != "R").alias("verified_purchase"),
    )


@query(
    "clean_reviews",
    f"""WITH {RAW_SQL}, cleaned AS (
      SELECT user_id || '_' || item_id || '_' || timestamp AS review_id, user_id, item_id, rating,
        {sql_clean('title')} AS title, {sql_clean('text')} AS text, CAST(helpful_vote AS INT) AS helpful_vote,
        verified_purchase, epoch_ms(timestamp) AS ts FROM raw WHERE rating BETWEEN 1 AND 5)
      SELECT review_id, user_id, item_id, rating, title, text, CAST(length(text) AS INT) AS text_length,
        false AS has_image, helpful_vote, verified_purchase, ts, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, ts
        ORDER BY rating, title, text, helpful_vote DESC, verified_purchase DESC) AS n FROM cleaned) WHERE n = 1""",
)
def clean_reviews(t):
    return C.process_reviews(raw_reviews(t))


@query(
    "ingest_counters",
    f"""WITH {RAW_SQL}, k AS (SELECT count(*) AS n, count(*) FILTER (rating BETWEEN 1 AND 5) AS v
          FROM raw GROUP BY user_id, item_id, timestamp)
        SELECT CAST(sum(n) AS BIGINT) AS raw_reviews, CAST(0 AS BIGINT) AS unreadable_lines,
          count(*) FILTER (v > 0) AS cleaned_reviews, CAST(sum(greatest(v - 1, 0)) AS BIGINT) AS duplicates_removed,
          CAST(sum(n - v) AS BIGINT) AS missing_dropped FROM k""",
)
def ingest_counters(t):
    return C.ingest_counters(raw_reviews(t))


@query(
    "dedup_lineitem",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem) WHERE n = 1""",
)
def dedup_lineitem(t):
    cols = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    li = t.raw("lineitem").select("l_orderkey", "l_linenumber", *cols)
    return C.first_of_copies(li, ["l_orderkey", "l_linenumber"], [F.asc(c) for c in cols])


@query(
    "price_parse",
    r"""WITH p AS (SELECT p_partkey AS item_id, CASE p_size % 4 WHEN 0 THEN '$' || printf('%.2f', p_retailprice)
           WHEN 1 THEN '$' || p_size || ',' || '0' || p_size || '.50' WHEN 2 THEN '$' || p_size || ' - $' || p_size
           ELSE '1.' || p_size || '.3' END AS price_text FROM part)
        SELECT item_id, price_text, TRY_CAST(nullif(regexp_replace(price_text, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price,
          p_range AS price_suspect FROM (SELECT *, price_text LIKE '% - %' AS p_range FROM p)""",
)
def price_parse(t):
    size = F.col("p_size").cast("string")
    kind = F.col("p_size") % 4
    text = (
        F.when(kind == 0, F.format_string("$%.2f", "p_retailprice"))
        .when(kind == 1, F.concat(F.lit("$"), size, F.lit(",0"), size, F.lit(".50")))
        .when(kind == 2, F.concat(F.lit("$"), size, F.lit(" - $"), size))
        .otherwise(F.concat(F.lit("1."), size, F.lit(".3")))
    )
    p = t.raw("part").select(F.col("p_partkey").alias("item_id"), text.alias("price_text"))
    return p.select("item_id", "price_text", S.parse_price("price_text").alias("price"), S.price_is_suspect("price_text").alias("price_suspect"))


def _sql_profile(table: str, cols: list[tuple[str, str, str]]) -> str:
    """cols: (name, Spark type, kind) with kind in text, number, other."""
    rows = []
    for name, dtype, kind in cols:
        num = f"CAST({name} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)"
        ln = f"length({name})" if kind == "text" else "NULL"
        empty = f"count(*) FILTER ({name} = '')" if kind == "text" else "CAST(0 AS BIGINT)"
        rows.append(
            f"""SELECT '{name}' AS column_name, '{dtype}' AS data_type, count(*) AS n_rows,
                count(*) FILTER ({name} IS NULL) AS null_count, {empty} AS empty_count, min({num}) AS min_value,
                max({num}) AS max_value, CAST(min({ln}) AS INT) AS min_length, CAST(max({ln}) AS INT) AS max_length,
                round(avg({ln}), 6) AS avg_length, count(*) FILTER ({name} IS NULL) > 0 AS nullable,
                round(CAST(count(*) FILTER ({name} IS NULL) AS DOUBLE) / count(*), 6) AS null_rate,
                count(DISTINCT {name}) AS unique_count FROM {table}"""
        )
    return " UNION ALL ".join(rows)


PROFILED = [("o_orderkey", "bigint", "number"), ("o_custkey", "bigint", "number"), ("o_orderstatus", "string", "text"),
            ("o_totalprice", "double", "number"), ("o_orderdate", "timestamp_ntz", "other"), ("o_orderpriority", "string", "text")]


@query("column_profile", _sql_profile("orders", PROFILED))
def column_profile(t):
    return P.column_profile(t.raw("orders"))


@query(
    "json_field_profile",
    """SELECT 'k' AS field, 'BIGINT' AS data_type, count(*) AS n_rows, CAST(0 AS BIGINT) AS null_count,
         min(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS min_value,
         max(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS max_value,
         CAST(max(length(json_extract_string(props, '$.k'))) AS INT) AS max_length,
         count(DISTINCT json_extract_string(props, '$.k')) AS unique_count FROM events""",
)
def json_field_profile(t):
    return P.json_field_profile(t.raw("events"), "props")


DICTIONARY = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string", "c_acctbal": "double"}


@query(
    "data_dictionary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS field_name, '{k}' AS data_type, count(*) FILTER ({c} IS NULL) > 0 AS nullable,
            count(DISTINCT {c}) AS unique_values, {f'CAST(min({c}) AS DOUBLE)' if k != 'string' else 'CAST(NULL AS DOUBLE)'} AS min,
            {f'CAST(max({c}) AS DOUBLE)' if k != 'string' else 'CAST(NULL AS DOUBLE)'} AS max,
            (SELECT string_agg(v, '; ' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM customer
               WHERE {c} IS NOT NULL ORDER BY v LIMIT 3)) AS sample_values FROM customer""" for c, k in DICTIONARY.items()
    ),
)
def data_dictionary(t):
    return P.data_dictionary(t.raw("customer").select(*[F.col(c).cast(k) for c, k in DICTIONARY.items()]))


@query(
    "missing_rates",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing,
            round(100 * avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_pct,
            {f"count(*) FILTER ({c} = '')" if k == 't' else 'CAST(0 AS BIGINT)'} AS empty,
            {f'count(*) FILTER ({c} = 0)' if k == 'n' else 'CAST(0 AS BIGINT)'} AS zero,
            {f'round(100 * CAST(count(*) FILTER ({c} = 0) AS DOUBLE) / count(*), 6)' if k == 'n' else 'CAST(0 AS DOUBLE)'} AS zero_pct
            FROM lineitem""" for c, k in [("l_discount", "n"), ("l_tax", "n"), ("l_quantity", "n"), ("l_returnflag", "t")]
    ),
)
def missing_rates(t):
    return P.missing_rates(t.raw("lineitem").select("l_discount", "l_tax", "l_quantity", "l_returnflag"))


@query(
    "quality_report",
    """WITH x AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS d,
           count(*) FILTER (NOT (l_tax > 0)) AS zt, count(*) FILTER (l_returnflag <> 'R') AS nr FROM lineitem),
         f AS (SELECT 'null_rate' AS c, CASE WHEN CAST(zt AS DOUBLE) / n > 0.5 THEN 'issue' ELSE 'warning' END AS s, n, d FROM x
                 WHERE CAST(zt AS DOUBLE) / n > 0.1
               UNION ALL SELECT 'null_rate', CASE WHEN CAST(nr AS DOUBLE) / n > 0.5 THEN 'issue' ELSE 'warning' END, n, d FROM x
                 WHERE CAST(nr AS DOUBLE) / n > 0.1
               UNION ALL SELECT 'duplicate_rate', 'warning', n, d FROM x WHERE n > d)
       SELECT (SELECT n FROM x) AS total_records, count(*) FILTER (s = 'issue') AS n_issues,
         count(*) FILTER (s = 'warning') AS n_warnings, count(*) FILTER (s = 'issue') = 0 AS is_valid FROM f""",
)
def quality_report(t):
    return P.quality_report(_lines_with_gaps(t), ["l_orderkey", "l_linenumber"]).drop("findings")


@query(
    "quality_findings",
    """WITH x AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS d,
           count(*) FILTER (NOT (l_tax > 0)) AS zt, count(*) FILTER (l_returnflag <> 'R') AS nr FROM lineitem)
       SELECT 'null_rate' AS check_name, 'tax' AS column_name, CASE WHEN zt / n > 0.5 THEN 'issue' ELSE 'warning' END AS severity,
         round(zt / n, 6) AS amount FROM x WHERE zt / n > 0.1
       UNION ALL SELECT 'null_rate', 'returned', CASE WHEN nr / n > 0.5 THEN 'issue' ELSE 'warning' END, round(nr / n, 6) FROM x WHERE nr / n > 0.1
       UNION ALL SELECT 'duplicate_rate', 'l_orderkey,l_linenumber', 'warning', round((n - d) / n, 6) FROM x WHERE n > d""",
)
def quality_findings(t):
    return P.quality_findings(_lines_with_gaps(t), ["l_orderkey", "l_linenumber"])


def _lines_with_gaps(t):
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"),
        F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).alias("returned"),
    )
