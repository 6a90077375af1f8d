"""Feature vectors, nearest neighbours and method comparison."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from opinara.functions import scalars as S
from opinara.functions.scalars import r6
from opinara.functions.text import title_and_description, tokens
from opinara.operators import features as FE
from opinara.operators import similarity as SIM
from opinara.operators.knn import nearest_neighbours
from opinara.operators.latent import latent_factors, latent_reduction
from opinara.operators.lookups import with_review_stats
from opinara.operators.tfidf import tfidf
from opinara.plans.registry import query
from opinara.plans.text import DOCS_TFIDF, TITLES_TFIDF, TOKENS_SQL, title_features
from opinara.session import materialise
from opinara.sources.tables import with_views

PATTERN_SQL = """SELECT user_id, avg(rating) AS avg_rating, coalesce(stddev_samp(rating), 0) AS rating_std, count(rating) AS review_count,
  min(rating) AS min_rating, max(rating) AS max_rating, CAST(sum(helpful_vote) AS BIGINT) AS total_helpful,
  avg(CASE WHEN verified_purchase THEN 1.0 ELSE 0.0 END) AS verified_ratio, avg(length(text)) AS avg_text_length FROM reviews GROUP BY user_id"""


@query("user_rating_patterns", with_views(f"""SELECT * REPLACE (round(avg_rating, 6) AS avg_rating, round(rating_std, 6) AS rating_std,
    round(verified_ratio, 6) AS verified_ratio, round(avg_text_length, 6) AS avg_text_length) FROM ({PATTERN_SQL})"""))
def user_rating_patterns(t):
    rounded = ["avg_rating", "rating_std", "verified_ratio", "avg_text_length"]
    return FE.rating_patterns(t.reviews).withColumns({c: r6(c) for c in rounded})


AFFINITY_SQL = """a AS (SELECT user_id, main_category, count(*) AS n FROM reviews r JOIN products p ON p.item_id = r.item_id GROUP BY ALL),
  sh AS (SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY user_id) AS share FROM a)"""


@query("category_affinity_long", with_views(f"WITH {AFFINITY_SQL} SELECT user_id, main_category, n, round(share, 6) AS share FROM sh"))
def category_affinity_long(t):
    return FE.category_affinity(t.reviews, t.products).withColumn("share", r6("share"))


CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]  # those of the catalogue


def categories(t) -> list[str]:
    """Category names of the catalogue, a short list."""
    return [r[0] for r in t.products.select("main_category").distinct().orderBy("main_category").collect()]


@query("category_affinity_wide", with_views(f"""WITH {AFFINITY_SQL}
    SELECT user_id, {", ".join(f"round(coalesce(sum(share) FILTER (main_category = '{c}'), 0), 6) AS {c.lower()}" for c in CATEGORIES)}
    FROM sh GROUP BY user_id"""))
def category_affinity_wide(t):
    wide = FE.category_affinity_wide(t.reviews, t.products, CATEGORIES)
    return wide.select("user_id", *[r6(c).alias(c.lower()) for c in CATEGORIES])


META_SQL = """st AS (SELECT item_id, avg(rating) AS a, count(rating) AS n FROM reviews GROUP BY item_id),
  mb AS (SELECT p.item_id, p.price, CAST(CAST('0x' || substr(md5(p.main_category), 1, 8) AS BIGINT) % 100 AS DOUBLE) / 100 AS category,
      coalesce(st.a, 0) AS avg_rating, CAST(least(coalesce(st.n, 0), 1000) AS DOUBLE) / 1000 AS rating_count
    FROM products p LEFT JOIN st ON st.item_id = p.item_id),
  mm AS (SELECT min(price) AS pl, max(price) AS ph, min(category) AS cl, max(category) AS ch, min(avg_rating) AS al, max(avg_rating) AS ah,
      min(rating_count) AS nl, max(rating_count) AS nh FROM mb),
  mf AS (SELECT item_id, (price - pl) / (ph - pl) AS price, (category - cl) / (ch - cl) AS category, (avg_rating - al) / (ah - al) AS avg_rating,
      (rating_count - nl) / (nh - nl) AS rating_count FROM mb, mm)"""


def _metadata(t):
    return FE.metadata_features(with_review_stats(t.products, t.reviews), S.md5_bucket)


@query("metadata_features", with_views(f"""WITH {META_SQL} SELECT item_id, round(price, 6) AS price, round(category, 6) AS category,
    round(avg_rating, 6) AS avg_rating, round(rating_count, 6) AS rating_count, CAST(0 AS DOUBLE) AS has_description,
    CAST(0 AS DOUBLE) AS has_features FROM mf"""))
def metadata_features(t):
    return _metadata(t).withColumns({c: r6(c) for c in FE.METADATA})


def _knn_sql(vectors: str, order: str, score: str, n: int = 10, extra: str = "") -> str:
    """vectors: CTEs ending in v(id, x) with x a DOUBLE list."""
    return f"""WITH {vectors}, s AS (SELECT a.id AS query_id, b.id AS neighbour_id, round({score}, 9) AS score FROM v a JOIN v b ON a.id <> b.id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score {order}, neighbour_id) AS INT) AS rank FROM s QUALIFY rank <= {n})
    SELECT query_id, neighbour_id, rank, {extra} FROM r"""


EMB = "v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
COSINE = "list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x)) / sqrt(list_dot_product(b.x, b.x))"
CHORD = "score AS similarity, round(sqrt(greatest(2 - 2 * score, 0)), 9) AS distance"


@query("knn_cosine", _knn_sql(EMB, "DESC", COSINE, 10, "score AS similarity"))
def knn_cosine(t):
    return nearest_neighbours(t.raw("embeddings"), 10, id_col="vec_id", vec_col="embedding").drop("distance")


@query("knn_l2", _knn_sql(EMB, "", "list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))", 10,
                          "score AS distance"))
def knn_l2(t):
    return nearest_neighbours(t.raw("embeddings"), 10, id_col="vec_id", vec_col="embedding", metric="l2").drop("similarity")


@query("knn_ivf")
def knn_ivf(t):
    return nearest_neighbours(t.raw("embeddings"), 10, id_col="vec_id", vec_col="embedding", method="ivf", n_cells=32, n_probe=8)


@query("knn_lsh")
def knn_lsh(t):
    return nearest_neighbours(t.raw("embeddings"), 10, id_col="vec_id", vec_col="embedding", method="lsh", bits=4)


@query("similar_products_metadata", with_views(_knn_sql(
    META_SQL + ", v AS (SELECT item_id AS id, [price, category, avg_rating, rating_count] AS x FROM mf)", "DESC", COSINE, 10, "score AS similarity")))
def similar_products_metadata(t):
    return nearest_neighbours(FE.as_vector(_metadata(t), "item_id", list(FE.METADATA)), 10).drop("distance")


ZMETA_SQL = """st AS (SELECT item_id, avg(rating) AS a, count(rating) AS n FROM reviews GROUP BY item_id),
  zb AS (SELECT p.item_id, p.price, coalesce(st.a, 0) AS a, coalesce(st.n, 0) AS n FROM products p LEFT JOIN st ON st.item_id = p.item_id),
  zs AS (SELECT avg(price) AS pm, stddev_samp(price) AS ps, avg(a) AS am, stddev_samp(a) AS asd, avg(n) AS nm, stddev_samp(n) AS ns FROM zb),
  v AS (SELECT item_id AS id, [(a - am) / asd, (n - nm) / ns, (price - pm) / ps] AS x FROM zb, zs)"""


@query("similar_products_zscore", with_views(_knn_sql(
    ZMETA_SQL, "", "list_sum(list_transform(range(1, 4), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))", 5,
    "score AS distance, round(1 / (1 + sqrt(score)), 6) AS similarity")))
def similar_products_zscore(t):
    stats = with_review_stats(t.products, t.reviews).withColumn("average_rating", F.coalesce("average_rating", F.lit(0.0)))
    cols = ["average_rating", "rating_number", "price"]
    vectors = FE.as_vector(FE.z_scored(stats, cols), "item_id", cols)
    near = nearest_neighbours(vectors, 5, metric="l2")
    return near.withColumn("similarity", r6(S.distance_to_similarity(F.sqrt("distance"))))


@query("similar_users_rating", with_views(_knn_sql(
    f"u AS ({PATTERN_SQL}), v AS (SELECT user_id AS id, [CAST(avg_rating AS DOUBLE), rating_std, review_count, min_rating, max_rating, total_helpful, "
    "verified_ratio, avg_text_length] AS x FROM u)", "DESC", COSINE, 10, "score AS similarity")))
def similar_users_rating(t):
    vectors = FE.as_vector(FE.rating_patterns(t.reviews), "user_id", list(FE.PATTERN), normalise=True)
    return nearest_neighbours(vectors, 10).drop("distance")


def _category_vectors(t):
    names = categories(t)
    return FE.as_vector(FE.category_affinity_wide(t.reviews, t.products, names), "user_id", names)


CATEGORY_V = AFFINITY_SQL + """, c AS (SELECT DISTINCT main_category FROM products),
  us AS (SELECT DISTINCT user_id FROM sh),
  v AS (SELECT us.user_id AS id, list(CAST(coalesce(sh.share, 0) AS DOUBLE) ORDER BY c.main_category) AS x FROM us CROSS JOIN c
    LEFT JOIN sh ON sh.user_id = us.user_id AND sh.main_category = c.main_category GROUP BY us.user_id)"""


@query("similar_users_category", with_views("WITH k AS (" + _knn_sql(CATEGORY_V, "DESC", COSINE, 10, "score AS similarity") + """)
    SELECT k.query_id, k.neighbour_id, k.rank, k.similarity, (SELECT count(*) FROM reviews r WHERE r.user_id = k.neighbour_id) AS review_count,
      round((SELECT avg(rating) FROM reviews r WHERE r.user_id = k.neighbour_id), 6) AS avg_rating FROM k"""))
def similar_users_category(t):
    near = nearest_neighbours(_category_vectors(t), 10).drop("distance")
    return SIM.with_user_details(near, t.reviews).withColumn("avg_rating", r6("avg_rating"))


@query("similar_users_category_ip", with_views(_knn_sql(CATEGORY_V, "DESC", "list_dot_product(a.x, b.x)", 10, "score AS similarity")))
def similar_users_category_ip(t):
    return nearest_neighbours(_category_vectors(t), 10, metric="ip").drop("distance")


def _blocks(t):
    """Three vectors per product that has a given embedding: its two halves and the metadata."""
    e = t.raw("embeddings").select(
        F.col("vec_id").alias("item_id"), F.slice("embedding", 1, 24).alias("a"), F.slice("embedding", 25, 40).alias("b")
    )
    return e.join(FE.as_vector(_metadata(t), "item_id", list(FE.METADATA)).withColumnRenamed("id", "item_id"), "item_id")


HYBRID_SQL = META_SQL + """, hb AS (SELECT e.vec_id AS item_id, CAST(e.embedding[1:24] AS DOUBLE[]) AS a, CAST(e.embedding[25:64] AS DOUBLE[]) AS b,
    [m.price, m.category, m.avg_rating, m.rating_count, 0, 0] AS m FROM embeddings e JOIN mf m ON m.item_id = e.vec_id)"""
UNPACK = """hn AS (SELECT item_id, h, sqrt(list_dot_product(h, h)) AS n FROM hv), hx AS (SELECT item_id, n, unnest(h) AS x,
    generate_subscripts(h, 1) - 1 AS pos FROM hn)
    SELECT item_id, CAST(pos AS INT) AS pos, round(x / CASE WHEN n = 0 THEN 1 ELSE n END, 6) AS x FROM hx"""


@query("hybrid_vector", with_views(f"""WITH {HYBRID_SQL}, hv AS (SELECT item_id, list_transform(a, lambda x: x * CAST(0.5 AS DOUBLE))
    || list_transform(b[1:24], lambda x: x * CAST(0.4 AS DOUBLE)) || list_transform(m || list_transform(range(18), lambda i: CAST(0 AS DOUBLE)),
      lambda x: x * CAST(0.1 AS DOUBLE)) AS h FROM hb), {UNPACK}"""))
def hybrid_vector(t):
    return _blocks(t).select("item_id", F.posexplode(FE.hybrid_weighted("a", "b", "vector", 24)).alias("pos", "x")).withColumn("x", r6("x"))


@query("hybrid_vector_truncated", with_views(f"WITH {HYBRID_SQL}, hv AS (SELECT item_id, a[1:16] || b[1:16] || m AS h FROM hb), {UNPACK}"))
def hybrid_vector_truncated(t):
    return _blocks(t).select("item_id", F.posexplode(FE.hybrid_truncated("a", "b", "vector", 16)).alias("pos", "x")).withColumn("x", r6("x"))


def hashed_sql(name: str, rows: str, dim: int) -> str:
    """A CTE `name`(id, x) of unit vectors from `rows` with id, term and w."""
    return f"""{name}_b AS (SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {dim} AS b, CAST(sum(w) AS DOUBLE) AS c FROM ({rows}) GROUP BY ALL),
  {name}_n AS (SELECT id, sqrt(sum(c * c)) AS n FROM {name}_b GROUP BY id),
  {name} AS (SELECT n.id, list(coalesce(b.c, 0) / n.n ORDER BY g.b) AS x FROM {name}_n n CROSS JOIN (SELECT unnest(range({dim})) AS b) g
    LEFT JOIN {name}_b b ON b.id = n.id AND b.b = g.b GROUP BY n.id)"""


# A conversation stands for a user, its turns for the user's reviews.
@query("similar_users_text", _knn_sql(hashed_sql("v", "SELECT conv_id AS id, unnest(" + TOKENS_SQL.format(
    c="concat_ws(' ', role, text)") + ") AS term, 1 AS w FROM conversations", 64), "DESC", COSINE, 10, "score AS similarity"))
def similar_users_text(t):
    return nearest_neighbours(FE.user_text_vectors(t.raw("conversations"), "conv_id", ("role", "text"), 64), 10).drop("distance")


def _product_blocks(t, dim: int = 32):
    """Term weights, words and metadata of every product."""
    docs = t.products.select("item_id", title_and_description("title", "main_category").alias("text"))
    words = docs.select("item_id", F.explode(tokens("text")).alias("w"))
    block = lambda df, name: df.withColumnsRenamed({"id": "item_id", "vector": name})
    zero = F.array_repeat(F.lit(0.0), dim)
    out = block(FE.as_vector(_metadata(t), "item_id", list(FE.METADATA)), "metadata")
    out = out.join(block(FE.hashed_vectors(title_features(t), "item_id", "term", F.col("weight"), dim), "terms"), "item_id", "left")
    out = out.join(block(FE.hashed_vectors(words, "item_id", "w", dim=dim), "words"), "item_id", "left")
    return out.withColumns({c: F.coalesce(c, zero) for c in ("terms", "words")})


ZEROS = "list_transform(range(32), lambda i: CAST(0 AS DOUBLE))"
PRODUCT_BLOCKS_SQL = META_SQL + ", " + TITLES_TFIDF + ", " + hashed_sql("pt", "SELECT doc AS id, term, weight AS w FROM f", 32) + ", " + hashed_sql(
    "pw", "SELECT p_partkey AS id, unnest(" + TOKENS_SQL.format(c="p_name || ' ' || p_type") + ") AS term, 1 AS w FROM part", 32) + f""",
  v AS (SELECT m.item_id AS id, list_transform(coalesce(pt.x, {ZEROS}), lambda x: x * CAST(0.5 AS DOUBLE))
      || list_transform(coalesce(pw.x, {ZEROS}), lambda x: x * CAST(0.4 AS DOUBLE))
      || list_transform([m.price, m.category, m.avg_rating, m.rating_count], lambda x: x * CAST(0.1 AS DOUBLE)) AS x
    FROM mf m LEFT JOIN pt ON pt.id = m.item_id LEFT JOIN pw ON pw.id = m.item_id)"""


@query("similar_products_hybrid", with_views(_knn_sql(PRODUCT_BLOCKS_SQL, "DESC", COSINE, 10, "score AS similarity")))
def similar_products_hybrid(t):
    vectors = _product_blocks(t).select(F.col("item_id").alias("id"), FE.hybrid_weighted("terms", "words", "metadata", 32).alias("vector"))
    return nearest_neighbours(vectors, 10).drop("distance")


@query("latent_vectors")
def latent_vectors(t):
    return latent_reduction(tfidf(t.documents, "doc_id", "text"))


# The titles have fewer terms than directions are kept, so the products of the reduced vectors are those of the weights.
@query("latent_category_products", with_views(f"""WITH {TITLES_TFIDF},
    c AS (SELECT p.main_category AS category, f.term, sum(f.weight) AS w FROM f JOIN products p ON p.item_id = f.doc GROUP BY ALL),
    n AS (SELECT p.main_category AS category, count(DISTINCT f.doc) AS n FROM f JOIN products p ON p.item_id = f.doc GROUP BY ALL)
    SELECT a.category, b.category AS other, round(sum(a.w * b.w) / (any_value(x.n) * any_value(y.n)), 6) AS product
    FROM c a JOIN c b ON a.term = b.term JOIN n x ON x.category = a.category JOIN n y ON y.category = b.category GROUP BY ALL"""))
def latent_category_products(t):
    docs, _ = latent_factors(title_features(t).withColumnRenamed("item_id", "doc"))
    of = docs.join(t.products.select(F.col("item_id").alias("doc"), F.col("main_category").alias("category")), "doc")
    mean = materialise(of.groupBy("category").agg(Summarizer.mean(array_to_vector("vector")).alias("v")).select("category", vector_to_array("v").alias("v")))
    other = mean.select(F.col("category").alias("other"), F.col("v").alias("u"))
    dims = lambda m, x: m.select(m.columns[0], F.posexplode(x).alias("i", x + "_i"))  # noqa: E731  one row for each category and direction
    pairs = dims(mean, "v").join(dims(other, "u"), "i").groupBy("category", "other")
    return pairs.agg(F.round(F.sum(F.col("v_i") * F.col("u_i")), 6).alias("product"))


@query("text_embeddings_hashed")
def text_embeddings_hashed(t):
    return FE.text_embeddings(t.documents, "doc_id", "text", dim=64)


@query("user_texts", """WITH p AS (SELECT conv_id, turn, CASE WHEN role IS NULL THEN '' ELSE role END || '. ' || coalesce(text, '') AS piece FROM conversations)
    SELECT conv_id AS user_id, string_agg(piece, ' ' ORDER BY turn, piece) AS combined_text FROM p GROUP BY conv_id""")
def user_texts(t):
    rows = t.raw("conversations").select(F.col("conv_id").alias("user_id"), "turn", F.col("role").alias("title"), "text")
    return FE.user_texts(rows, ["turn"])


# Documents and embeddings share their ids here, so both describe one set of items.
METHODS_SQL = f"""{DOCS_TFIDF},
  ts AS (SELECT a.doc AS q, b.doc AS n, round(sum(a.weight * b.weight), 9) AS s FROM f a JOIN f b ON a.term = b.term AND a.doc <> b.doc GROUP BY ALL),
  tr AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY s DESC, n) AS INT) AS r FROM ts QUALIFY r <= 10),
  {EMB},
  es AS (SELECT a.id AS q, b.id AS n, (round({COSINE}, 9) + 1) / 2 AS s FROM v a JOIN v b ON a.id <> b.id),
  er AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY s DESC, n) AS INT) AS r FROM es QUALIFY r <= 10),
  hs AS (SELECT coalesce(er.q, tr.q) AS q, coalesce(er.n, tr.n) AS n, round(CAST(0.6 AS DOUBLE) * coalesce(er.s, 0) + CAST(0.4 AS DOUBLE) * coalesce(tr.s, 0), 10) AS s
    FROM er FULL JOIN tr ON er.q = tr.q AND er.n = tr.n),
  hr AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY s DESC, n) AS INT) AS r FROM hs QUALIFY r <= 5),
  mc AS (SELECT 'tfidf' AS method, q, n, s, r FROM tr WHERE r <= 5 UNION ALL SELECT 'embedding', q, n, s, r FROM er WHERE r <= 5
    UNION ALL SELECT 'hybrid', q, n, s, r FROM hr)"""


def _methods(t):
    terms = SIM.similar_by_terms(tfidf(t.documents, "doc_id", "text"), 10)
    emb = nearest_neighbours(t.raw("embeddings"), 10, id_col="vec_id", vec_col="embedding")
    emb = emb.withColumn("similarity", S.cosine_to_unit("similarity"))
    hybrid = SIM.hybrid_score(emb, terms, 5)
    first = lambda df: df.filter(F.col("rank") <= 5)
    return SIM.compare_methods({"tfidf": first(terms), "embedding": first(emb), "hybrid": hybrid})


@query("hybrid_score", f"WITH {METHODS_SQL} SELECT q AS query_id, n AS neighbour_id, s AS similarity, r AS rank FROM hr")
def hybrid_score(t):
    return _methods(t).filter(F.col("method") == "hybrid").drop("method")


@query("method_comparison", f"WITH {METHODS_SQL} SELECT method, q AS query_id, n AS neighbour_id, s AS similarity, r AS rank FROM mc")
def method_comparison(t):
    return _methods(t)


@query("method_comparison_table", f"""WITH {METHODS_SQL},
    c AS (SELECT mc.q, mc.r, mc.method, CASE WHEN length(d.lang || '-' || d.source) > 35 THEN substring(d.lang || '-' || d.source, 1, 35) || '...'
        ELSE d.lang || '-' || d.source END || ' (' || printf('%.2f', mc.s) || ')' AS cell FROM mc JOIN documents d ON d.doc_id = mc.n)
    SELECT g.q AS query_id, CAST(k.r AS INT) AS rank, coalesce(max(cell) FILTER (method = 'tfidf'), '—') AS tfidf,
      coalesce(max(cell) FILTER (method = 'embedding'), '—') AS embedding, coalesce(max(cell) FILTER (method = 'hybrid'), '—') AS hybrid
    FROM (SELECT DISTINCT q FROM mc) g CROSS JOIN (SELECT unnest(range(1, 6)) AS r) k LEFT JOIN c ON c.q = g.q AND c.r = k.r GROUP BY g.q, k.r""")
def method_comparison_table(t):
    titles = t.documents.select(F.col("doc_id").alias("id"), F.concat_ws("-", "lang", "source").alias("title"))
    return SIM.comparison_table(_methods(t), titles, ["tfidf", "embedding", "hybrid"])


@query("method_top_scores", f"WITH {METHODS_SQL} SELECT q AS query_id, method, max(s) AS top_score FROM mc GROUP BY q, method")
def method_top_scores(t):
    return SIM.top_score_per_method(_methods(t))
