"""Search and term similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions.text import STEM_RULES, STOP_WORDS, title_and_description
from opinara.operators import recommend as R
from opinara.operators import similarity as SIM
from opinara.operators.search import contains_search, field_search, keyword_search
from opinara.operators.tfidf import tfidf
from opinara.plans.registry import query
from opinara.sources.tables import with_views

TOKENS_SQL = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]{{2,}}')"
SEARCHES = {"q1": "the ation", "q2": "der und sch", "q3": "que le", "q4": "of ing"}
SEARCH_SQL = """q(query_id, term) AS (VALUES ('q1', 'the'), ('q1', 'ation'), ('q2', 'der'), ('q2', 'und'), ('q2', 'sch'),
    ('q3', 'que'), ('q3', 'le'), ('q4', 'of'), ('q4', 'ing')),
  w AS (SELECT doc_id AS doc, """ + TOKENS_SQL.format(c="text") + """ AS w FROM documents),
  st AS (SELECT count(*) AS n, avg(len(w)) AS avg_len FROM w),
  h AS (SELECT doc, len, term, count(*) AS tf FROM (SELECT doc, len(w) AS len, unnest(w) AS term FROM w)
    WHERE term IN (SELECT term FROM q) GROUP BY ALL),
  d AS (SELECT term, count(*) AS df FROM h GROUP BY term),
  s AS (SELECT q.query_id, h.doc, round(sum(ln(1 + (st.n - d.df + CAST(0.5 AS DOUBLE)) / (d.df + CAST(0.5 AS DOUBLE)))
      * (h.tf * CAST(2.2 AS DOUBLE) / (h.tf + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * h.len / st.avg_len)))), 9) AS score,
      count(*) AS matched, (SELECT count(*) FROM q x WHERE x.query_id = q.query_id) AS n_terms
    FROM h JOIN q ON q.term = h.term JOIN d ON d.term = h.term, st GROUP BY q.query_id, h.doc),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS INT) AS rank FROM s WHERE {cond})
  SELECT query_id, doc, score, rank FROM r WHERE rank <= 20"""


@query("keyword_search_all", "WITH " + SEARCH_SQL.replace("{cond}", "matched = n_terms"))
def keyword_search_all(t):
    return keyword_search(t.documents, "doc_id", "text", SEARCHES, "all")


@query("keyword_search_any", "WITH " + SEARCH_SQL.replace("{cond}", "true"))
def keyword_search_any(t):
    return keyword_search(t.documents, "doc_id", "text", SEARCHES, "any")


def stem_sql(word: str) -> str:
    for kept, ending, other in STEM_RULES:
        word = f"regexp_replace({word}, '^({kept}){ending}$', '\\1{other}')"
    return word


FIELDS = {"title": 2.0, "main_category": 1.0}
FIELD_SEARCHES = {"q1": "rings", "q2": "economies bolting", "q3": "smalls gizmos", "q4": "red promos", "q5": "hot larges"}
FIELD_SQL = f"""a(query_id, q) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in FIELD_SEARCHES.items())}),
  q AS (SELECT DISTINCT query_id, {stem_sql("t")} AS term FROM (SELECT query_id, unnest({TOKENS_SQL.format(c="q")}) AS t FROM a)),
  w AS (SELECT item_id AS doc, 2.0 AS weight, 1 AS field, {TOKENS_SQL.format(c="title")} AS w FROM products
    UNION ALL SELECT item_id, 1.0, 2, {TOKENS_SQL.format(c="main_category")} FROM products),
  al AS (SELECT field, avg(len(w)) AS avg_len FROM w GROUP BY field),
  o AS (SELECT doc, {stem_sql("t")} AS term, CAST(weight AS DOUBLE) / (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * n / avg_len) AS tf
    FROM (SELECT doc, weight, field, len(w) AS n, unnest(w) AS t FROM w) JOIN al USING (field)),
  h AS (SELECT doc, term, sum(tf) AS tf FROM o WHERE term IN (SELECT term FROM q) GROUP BY ALL),
  d AS (SELECT term, count(*) AS df FROM h GROUP BY term),
  s AS (SELECT q.query_id, h.doc, round(sum(ln(1 + ((SELECT count(*) FROM products) - d.df + CAST(0.5 AS DOUBLE)) / (d.df + CAST(0.5 AS DOUBLE)))
      * h.tf * CAST(2.2 AS DOUBLE) / (h.tf + CAST(1.2 AS DOUBLE))), 9) AS score, count(*) AS matched,
      (SELECT count(*) FROM q x WHERE x.query_id = q.query_id) AS n_terms
    FROM h JOIN q ON q.term = h.term JOIN d ON d.term = h.term GROUP BY q.query_id, h.doc)
  SELECT query_id, doc, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS INT) AS rank
  FROM s WHERE matched = n_terms QUALIFY rank <= 20"""


@query("field_search_stems", with_views("WITH " + FIELD_SQL))
def field_search_stems(t):
    return field_search(t.products, "item_id", FIELDS, FIELD_SEARCHES)


@query("keyword_search_contains", with_views("""SELECT item_id, title, main_category, price FROM products
    WHERE contains(title, 'widget') OR contains(store, 'widget') ORDER BY item_id LIMIT 20"""))
def keyword_search_contains(t):
    return contains_search(t.products, "item_id", ["title", "store"], "widget").select("item_id", "title", "main_category", "price")


STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


def tfidf_sql(table: str, id_col: str, text: str, limits: str, max_features: int | None) -> str:
    """CTEs ending in `f(doc, term, tf, df, weight)`; words and word pairs."""
    cap = f"ORDER BY total DESC, term LIMIT {max_features}" if max_features else ""
    return f"""wl AS (SELECT {id_col} AS doc, list_filter({TOKENS_SQL.format(c=text)}, lambda x: x NOT IN ({STOP_SQL})) AS w FROM {table}),
  tm AS (SELECT doc, unnest(w) AS term FROM wl UNION ALL
    SELECT doc, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM wl),
  tc AS (SELECT doc, term, count(*) AS tf FROM tm GROUP BY ALL),
  nn AS (SELECT count(*) AS n FROM {table}),
  vo AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tc GROUP BY term HAVING {limits} {cap}),
  wt AS (SELECT tc.doc, tc.term, tc.tf, vo.df, tc.tf * (ln(CAST(1 + n AS DOUBLE) / (1 + vo.df)) + 1) AS w FROM tc JOIN vo ON vo.term = tc.term, nn),
  f AS (SELECT doc, term, tf, df, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS weight FROM wt)"""


DOCS_TFIDF = tfidf_sql("documents", "doc_id", "text", "count(*) >= 2 AND count(*) <= CAST(0.8 AS DOUBLE) * (SELECT n FROM nn)", None)


@query("tfidf_terms", f"WITH {DOCS_TFIDF} SELECT doc, term, tf, df, round(weight, 9) AS weight FROM f")
def tfidf_terms(t):
    return tfidf(t.documents, "doc_id", "text").withColumn("weight", F.round("weight", 9))


@query("tfidf_cosine_topk", f"""WITH {DOCS_TFIDF},
    s AS (SELECT a.doc AS query_id, b.doc AS neighbour_id, round(sum(a.weight * b.weight), 9) AS similarity FROM f a JOIN f b
      ON a.term = b.term AND a.doc <> b.doc GROUP BY ALL)
    SELECT query_id, neighbour_id, similarity, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY similarity DESC, neighbour_id) AS r FROM s) WHERE r <= 10""")
def tfidf_cosine_topk(t):
    return SIM.similar_by_terms(tfidf(t.documents, "doc_id", "text"), 10)


TITLES_TFIDF = tfidf_sql("part", "p_partkey", "p_name || ' ' || p_type", "count(*) >= 2 AND count(*) <= CAST(0.8 AS DOUBLE) * (SELECT n FROM nn)", None)
CONTENT_SQL = f"""{TITLES_TFIDF},
  g AS (SELECT user_id, item_id FROM reviews WHERE rating >= 4),
  b AS (SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS r
      FROM reviews WHERE user_id NOT IN (SELECT user_id FROM g)) WHERE r <= 3),
  l AS (SELECT * FROM g UNION ALL SELECT * FROM b),
  pr AS (SELECT l.user_id, f.term, sum(f.weight) / (SELECT count(*) FROM l y WHERE y.user_id = l.user_id) AS w
      FROM l JOIN f ON f.doc = l.item_id GROUP BY l.user_id, f.term),
  cs AS (SELECT pr.user_id, f.doc AS item_id, round(sum(pr.w * f.weight), 9) AS score FROM pr JOIN f ON f.term = pr.term GROUP BY ALL),
  cf AS (SELECT * FROM cs WHERE NOT EXISTS (SELECT 1 FROM ratings m WHERE m.user_id = cs.user_id AND m.item_id = cs.item_id)),
  cr AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INT) AS rank FROM cf)"""


def title_features(t):
    docs = t.products.select("item_id", title_and_description("title", "main_category").alias("text"))
    return tfidf(docs, "item_id", "text").select(F.col("doc").alias("item_id"), "term", "weight")


@query("content_based", with_views(f"WITH {CONTENT_SQL} SELECT user_id, item_id, score, rank FROM cr WHERE rank <= 10"))
def content_based(t):
    return R.recommend_content_based(t.reviews, title_features(t), 10)


@query("cold_start_item", with_views(f"""WITH {TITLES_TFIDF},
    s AS (SELECT a.doc AS query_id, b.doc AS neighbour_id, round(sum(a.weight * b.weight), 9) AS similarity FROM f a JOIN f b
      ON a.term = b.term AND a.doc <> b.doc GROUP BY ALL)
    SELECT query_id, neighbour_id, similarity, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY similarity DESC, neighbour_id) AS r FROM s) WHERE r <= 10"""))
def cold_start_item(t):
    f = title_features(t)
    return SIM.similar_by_terms(f.withColumnRenamed("item_id", "doc"), 10)
