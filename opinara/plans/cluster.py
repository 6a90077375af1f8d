"""Clustering, cluster quality and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions.scalars import r6
from opinara.operators import cluster as CL
from opinara.operators import features as FE
from opinara.operators.dbscan import dbscan
from opinara.operators.lookups import with_review_stats
from opinara.plans.registry import query
from opinara.plans.similarity import CATEGORY_V, META_SQL, PATTERN_SQL, _category_vectors, _metadata
from opinara.session import materialise
from opinara.sources.tables import with_views

MICRO = 200  # groups from which the merge tree starts
USER_FEATURES = ["avg_rating", "rating_std", "review_count", "verified_ratio", "avg_text_length"]


def user_features(t):
    return FE.as_vector(FE.rating_patterns(t.reviews), "user_id", USER_FEATURES)


def embeddings(t):
    return t.raw("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query("standardised_features", with_views(f"""WITH u AS ({PATTERN_SQL})
    SELECT user_id AS id, {', '.join(f"round((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in USER_FEATURES)} FROM u"""))
def standardised_features(t):
    z = CL.standardise(user_features(t))
    return z.select("id", *[r6(F.get("vector", F.lit(i))).alias(c) for i, c in enumerate(USER_FEATURES)])


@query("kmeans_clusters")
def kmeans_clusters(t):
    return CL.kmeans(user_features(t), 3)


@query("choose_k")
def choose_k(t):
    return CL.choose_k(CL.standardise(user_features(t)))


@query("cluster_metrics")
def cluster_metrics(t):
    users, vectors = materialise(user_features(t)), materialise(FE.as_vector(_metadata(t), "item_id", list(FE.METADATA)))
    km, ward = CL.kmeans(users, 3), CL.hierarchical(vectors, 5, micro=MICRO)
    return CL.run_report("kmeans", CL.with_vectors(km, users)).unionByName(CL.run_report("ward", CL.with_vectors(ward, vectors)))


@query("cluster_quality_of_labels", """WITH v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    l AS (SELECT id, label, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
    m AS (SELECT i, avg(x) AS m FROM l GROUP BY i), c AS (SELECT label, i, avg(x) AS c, count(*) AS n FROM l GROUP BY label, i),
    b AS (SELECT sum(c.n * (c.c - m.m) * (c.c - m.m)) AS b FROM c JOIN m ON m.i = c.i),
    w AS (SELECT sum((l.x - c.c) * (l.x - c.c)) AS w FROM l JOIN c ON c.label = l.label AND c.i = l.i),
    k AS (SELECT count(DISTINCT label) AS k, count(*) AS n FROM v),
    d AS (SELECT l.id, l.label, sqrt(sum((l.x - c.c) * (l.x - c.c))) AS d FROM l JOIN c ON c.label = l.label AND c.i = l.i GROUP BY l.id, l.label),
    s AS (SELECT label, avg(d) AS s FROM d GROUP BY label),
    g AS (SELECT a.label AS p, z.label AS q, sqrt(sum((a.c - z.c) * (a.c - z.c))) AS g FROM c a JOIN c z ON a.i = z.i AND a.label <> z.label GROUP BY ALL),
    r AS (SELECT g.p, max((x.s + y.s) / g.g) AS r FROM g JOIN s x ON x.label = g.p JOIN s y ON y.label = g.q GROUP BY g.p),
    pd AS (SELECT a.id, a.label AS own, z.label, sum(list_sum(list_transform(range(1, 65), lambda i: (a.x[i] - z.x[i]) * (a.x[i] - z.x[i])))) AS t,
      count(*) AS n FROM v a JOIN v z ON true GROUP BY ALL),
    ab AS (SELECT id, max(CASE WHEN own = label THEN t / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> label THEN t / n END) AS b,
      max(CASE WHEN own = label THEN n END) AS n FROM pd GROUP BY id)
    SELECT round(b * (n - k) / (w * (k - 1)), 6) AS calinski_harabasz, round((SELECT avg(r) FROM r), 6) AS davies_bouldin,
      round((SELECT avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) FROM ab), 6) AS silhouette FROM b, w, k""")
def cluster_quality_of_labels(t):
    labelled = t.raw("embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").alias("cluster")
    )
    report = CL.run_report("given", labelled)
    return report.select(*[r6(c).alias(c) for c in ("calinski_harabasz", "davies_bouldin", "silhouette")])


# Labels spread from core point to core point until none changes; clusters are numbered by their lowest core id.
def dbscan_sql(vectors: str, eps: float, min_samples: int) -> str:
    """vectors: CTEs ending in v(id, x) with x a DOUBLE list."""
    return with_views(f"""WITH {vectors},
    l AS (SELECT id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
    m AS (SELECT i, avg(x) AS m, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS s FROM l GROUP BY i),
    z AS (SELECT id, list((x - m) / s ORDER BY i) AS x FROM l JOIN m USING (i) GROUP BY id),
    e AS (SELECT a.id AS a, b.id AS b FROM z a JOIN z b ON list_distance(a.x, b.x) <= CAST({eps} AS DOUBLE)),
    core AS (SELECT a AS id FROM e GROUP BY a HAVING count(*) >= {min_samples}),
    ce AS MATERIALIZED (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    cc(id, label) USING KEY (id) AS (SELECT id, id FROM core UNION
      (SELECT old.id, min(c.label) FROM recurring.cc old JOIN ce ON ce.a = old.id JOIN cc c ON c.id = ce.b WHERE c.label < old.label GROUP BY old.id)),
    nr AS (SELECT id, dense_rank() OVER (ORDER BY label) - 1 AS cluster FROM cc),
    lb AS (SELECT id, cluster FROM nr UNION ALL SELECT e.a, min(nr.cluster) FROM e JOIN nr ON nr.id = e.b
      WHERE e.a NOT IN (SELECT id FROM core) GROUP BY e.a)
    SELECT v.id, coalesce(lb.cluster, -1) AS cluster, round(v.x[1], 6) AS feature_1, round(v.x[2], 6) AS feature_2 FROM v LEFT JOIN lb ON lb.id = v.id""").replace("WITH ", "WITH RECURSIVE ", 1)


@query("dbscan_clusters", dbscan_sql(CATEGORY_V, 0.3, 10))
def dbscan_clusters(t):
    out = dbscan(_category_vectors(t), eps=0.3, min_samples=10)
    return out.withColumns({c: r6(c) for c in ("feature_1", "feature_2")})


META_V = META_SQL + ", v AS (SELECT item_id AS id, [price, category, avg_rating, rating_count, 0, 0] AS x FROM mf)"


@query("dbscan_product_groups", dbscan_sql(META_V, 0.5, 10))
def dbscan_product_groups(t):
    out = dbscan(FE.as_vector(_metadata(t), "item_id", list(FE.METADATA)), eps=0.5, min_samples=10)
    return out.withColumns({c: r6(c) for c in ("feature_1", "feature_2")})


@query("dbscan_noise_flags", with_views("""WITH i AS (SELECT item_id, avg(rating) AS a, count(rating) AS n FROM reviews GROUP BY item_id),
    z AS (SELECT item_id, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS x, (n - avg(n) OVER ()) / stddev_pop(n) OVER () AS y FROM i),
    d AS (SELECT a.item_id, b.item_id AS other FROM z a JOIN z b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= CAST(0.0225 AS DOUBLE)),
    c AS (SELECT item_id FROM d GROUP BY item_id HAVING count(*) >= 8)
    SELECT z.item_id, z.item_id NOT IN (SELECT d.item_id FROM d WHERE d.other IN (SELECT item_id FROM c)) AS is_noise FROM z"""))
def dbscan_noise_flags(t):
    stats = t.reviews.groupBy("item_id").agg(F.avg("rating").alias("a"), F.count("rating").alias("n"))
    out = dbscan(FE.as_vector(stats, "item_id", ["a", "n"]), eps=0.15, min_samples=8)
    return out.select(F.col("id").alias("item_id"), (F.col("cluster") == -1).alias("is_noise"))


@query("ward_clusters")
def ward_clusters(t):
    return CL.hierarchical(FE.as_vector(_metadata(t), "item_id", list(FE.METADATA)), 5, micro=MICRO)


@query("pca_2d")
def pca_2d(t):
    out = CL.pca(embeddings(t), 2)
    return out.select("id", F.get("components", F.lit(0)).alias("component_1"), F.get("components", F.lit(1)).alias("component_2"))


USER_CLUSTERS = "SELECT c_custkey AS id, c_nationkey % 6 - 1 AS cluster FROM customer"
PRODUCT_CLUSTERS = "SELECT p_partkey AS id, p_size % 5 - 1 AS cluster FROM part"


def _user_clusters(t):
    return t.raw("customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 6 - 1).alias("cluster"))


def _product_clusters(t):
    return t.raw("part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 5 - 1).alias("cluster"))


@query("user_cluster_profiles", with_views(f"""WITH k AS ({USER_CLUSTERS}), z AS (SELECT cluster, count(*) AS size FROM k WHERE cluster <> -1 GROUP BY cluster)
    SELECT z.cluster, any_value(z.size) AS size, round(avg(r.rating), 6) AS avg_rating, round(stddev_samp(r.rating), 6) AS rating_std,
      count(r.rating) AS total_reviews, round(100 * avg(CASE WHEN r.verified_purchase THEN 1.0 ELSE 0.0 END), 6) AS verified_purchase_pct
    FROM z JOIN k ON k.cluster = z.cluster JOIN reviews r ON r.user_id = k.id GROUP BY z.cluster"""))
def user_cluster_profiles(t):
    out = CL.user_cluster_profile(_user_clusters(t), t.reviews)
    return out.withColumns({c: r6(c) for c in ("avg_rating", "rating_std", "verified_purchase_pct")})


@query("product_cluster_profiles", with_views(f"""WITH k AS ({PRODUCT_CLUSTERS}), st AS (SELECT item_id, avg(rating) AS a FROM reviews GROUP BY item_id),
    x AS (SELECT k.cluster, p.item_id, p.title, p.price, st.a, row_number() OVER (PARTITION BY k.cluster ORDER BY p.item_id) AS r
      FROM k JOIN products p ON p.item_id = k.id LEFT JOIN st ON st.item_id = p.item_id WHERE k.cluster <> -1)
    SELECT cluster, count(*) AS size, round(avg(price), 6) AS avg_price, min(price) AS min_price, max(price) AS max_price,
      round(avg(a), 6) AS avg_rating, string_agg(title, '|' ORDER BY r) FILTER (r <= 3) AS sample_products FROM x GROUP BY cluster"""))
def product_cluster_profiles(t):
    out = CL.product_cluster_profile(_product_clusters(t), with_review_stats(t.products, t.reviews))
    out = out.withColumns({c: r6(c) for c in ("avg_price", "avg_rating")})
    return out.withColumn("sample_products", F.array_join("sample_products", "|"))


@query("cluster_top_categories", with_views(f"""WITH k AS ({USER_CLUSTERS}), x AS (SELECT k.cluster, p.main_category, count(*) AS n FROM k
      JOIN reviews r ON r.user_id = k.id JOIN products p ON p.item_id = r.item_id WHERE k.cluster <> -1 GROUP BY ALL)
    SELECT cluster, main_category, n, CAST(row_number() OVER (PARTITION BY cluster ORDER BY n DESC, main_category) AS INT) AS rank
    FROM x QUALIFY rank <= 3"""))
def cluster_top_categories(t):
    rows = t.reviews.select("user_id", "item_id").join(t.products.select("item_id", "main_category"), "item_id")
    return CL.top_categories(_user_clusters(t), rows, "user_id", 3)
