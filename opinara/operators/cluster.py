"""k-means, hierarchical clustering, projection and cluster quality.

Inputs are (`id`, `vector`) tables with array vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.vectors import as_doubles
from opinara.operators import kmeans as KM
from opinara.operators.toprows import top_n_per_key
from opinara.session import materialise

STARTS = 10


def _literal(values):
    return F.array(*[F.lit(float(v)) for v in values])


def standardise(features: DataFrame) -> DataFrame:
    """Zero mean and unit population deviation per coordinate; a constant coordinate becomes 0."""
    if features.isEmpty():
        return features
    m = features.select(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(as_doubles("vector"))).alias("s")).first()
    n, mean, var = m["s"]["count"], m["s"]["mean"].toArray(), m["s"]["variance"].toArray()  # one value per coordinate
    std = np.sqrt(var * (n - 1) / n)
    std[std == 0] = 1.0
    centred = F.zip_with(as_doubles("vector"), _literal(mean), lambda x, c: x - c)
    return features.withColumn("vector", F.zip_with(centred, _literal(std), lambda x, s: x / s))


def _prepared(features: DataFrame) -> DataFrame:
    """(`ticket`, `id`, `vector`), on every core: the ticket decides draws, whatever the partitions."""
    data = materialise(features.select(F.xxhash64("id").alias("ticket"), "id", as_doubles("vector").alias("vector")))
    cores = data.sparkSession.sparkContext.defaultParallelism
    return data if len(data.inputFiles()) >= cores else materialise(data.repartition(cores))


def _vectors(data: DataFrame) -> DataFrame:
    return data.select("ticket", "vector")


def kmeans(features: DataFrame, k: int | None = None, max_k: int = 10, starts: int = STARTS, seed: int = 42) -> DataFrame:
    """(`id`, `cluster`, `feature_1`, `feature_2`) on standardised features.

    Clusters are numbered by their centres. Without `k` the best silhouette decides.
    """
    features = materialise(features)
    scaled = standardise(features)
    if k is None:
        k = best_k(choose_k(scaled, max_k, starts, seed))
    data = _prepared(scaled)
    models = KM.best_models(KM.fit_models(_vectors(data), [k], starts, seed))
    if not models:
        return _assignment(data.select("id", F.lit(0).alias("cluster")), features)
    return _assignment(KM.assign(data.select("id", "vector"), models[k].centres), features)


def _assignment(labelled: DataFrame, features: DataFrame) -> DataFrame:
    at = lambda i: F.coalesce(F.get(as_doubles("vector"), F.lit(i)), F.lit(0.0))
    raw = features.select("id", at(0).alias("feature_1"), at(1).alias("feature_2"))
    return labelled.select("id", "cluster").join(raw, "id")


def choose_k(features: DataFrame, max_k: int = 10, starts: int = STARTS, seed: int = 42) -> DataFrame:
    """(`k`, `inertia`, `silhouette`) for k = 2..`max_k`, on the features as given.

    All numbers and all starts advance together, one pass over the vectors for each iteration.
    """
    data = _vectors(_prepared(features))
    models = KM.best_models(KM.fit_models(data, list(range(2, max_k + 1)), starts, seed))
    centres = [m.centres for m in models.values()]
    sums = [s[:3] for s in KM.grouped_sums(data, centres)] if centres else []
    quality = KM.mean_silhouettes(data, lambda x: [KM.squared_distances(x, c).argmin(axis=1) for c in centres], sums)
    rows = [(k, m.inertia, s) for (k, m), s in zip(models.items(), quality, strict=True)]
    return features.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def best_k(curve: DataFrame) -> int:
    return curve.orderBy(F.desc("silhouette"), F.asc("k")).first()["k"]


def silhouette(labelled: DataFrame) -> float:
    """Mean silhouette of all rows of (`id`, `vector`, `cluster`) on squared Euclidean distances.

    The mean squared distance from x to a cluster follows from the cluster's count, vector
    sum and sum of squares: |x|^2 + sq / n - 2 x.total / n. So one grouped pass and one pass over the rows
    suffice; every task holds one vector per cluster. Rows are taken relative to the mean of all, which keeps the digits.
    A row alone in its cluster counts 0; fewer than two clusters give -1.
    """
    centre = labelled.agg(Summarizer.mean(array_to_vector("vector")).alias("m")).first()["m"]
    if centre is None:
        return -1.0
    shifted = labelled.select("cluster", F.zip_with("vector", _literal(centre.toArray()), lambda x, c: x - c).alias("vector"))
    sums = _cluster_sums(shifted)
    if len(sums) < 2:
        return -1.0
    n, total, square = np.array([r["n"] for r in sums], float), np.array([r["total"].toArray() for r in sums]), np.array([r["sq"] for r in sums])
    place = {r["cluster"]: i for i, r in enumerate(sums)}

    def score(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x, own = np.stack(pdf["vector"].to_numpy()), pdf["cluster"].map(place).to_numpy()
            mean = np.maximum((x * x).sum(axis=1)[:, None] + square / n - 2 * (x @ total.T) / n, 0.0)
            at = np.arange(len(x))
            a = mean[at, own] * n[own] / np.maximum(n[own] - 1, 1)
            mean[at, own] = np.inf
            b = mean.min(axis=1)
            most = np.maximum(a, b)
            yield pd.DataFrame({"s": np.where((n[own] > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1), 0.0)})

    return float(shifted.mapInPandas(score, "s double").agg(F.avg("s")).first()[0])


def _cluster_sums(labelled: DataFrame) -> list:
    """Per cluster: rows, vector sum and sum of squared lengths (one row per cluster)."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return (
        labelled.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(array_to_vector("vector")).alias("total"), F.sum(square).alias("sq"))
        .orderBy("cluster").collect()
    )


def calinski_harabasz(labelled: DataFrame) -> float | None:
    """Between- over within-cluster dispersion from one grouped pass."""
    g = _cluster_sums(labelled)
    n, k = sum(r["n"] for r in g), len(g)
    if k < 2 or n <= k:
        return None
    totals = np.array([r["total"].toArray() for r in g])
    sizes = np.array([r["n"] for r in g], dtype=np.float64)
    centre = totals.sum(axis=0) / n
    means = totals / sizes[:, None]
    between = (sizes * ((means - centre) ** 2).sum(axis=1)).sum()
    within = sum(r["sq"] for r in g) - (sizes * (means ** 2).sum(axis=1)).sum()
    return 1.0 if within <= 0 else float(between * (n - k) / (within * (k - 1)))


def davies_bouldin(labelled: DataFrame) -> float | None:
    """Mean over clusters of the worst (scatter + scatter) / centre distance."""
    g = _cluster_sums(labelled)
    if len(g) < 2:
        return None
    means = {r["cluster"]: r["total"].toArray() / r["n"] for r in g}
    centre = F.create_map(*[x for c, m in means.items() for x in (F.lit(c), _literal(m))])[F.col("cluster")]
    away = F.sqrt(F.aggregate(F.zip_with("vector", centre, lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda s, x: s + x))
    scatter = {r["cluster"]: r["s"] for r in labelled.groupBy("cluster").agg(F.avg(away).alias("s")).collect()}
    names = sorted(means)
    m, s = np.array([means[c] for c in names]), np.array([scatter[c] for c in names])
    gap = np.sqrt(((m[:, None, :] - m[None, :, :]) ** 2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(gap > 0, (s[:, None] + s[None, :]) / gap, 0.0)
    np.fill_diagonal(ratio, 0.0)
    return float(ratio.max(axis=1).mean())


def run_report(algorithm: str, labelled: DataFrame, with_noise: bool = False) -> DataFrame:
    """One row per run: clusters, noise and quality. `labelled` has id, vector, cluster; it is read many times, so it is written once."""
    labelled = materialise(labelled.select("id", "vector", "cluster"))
    counts = labelled.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cluster") == -1).alias("noise")).first()
    real = labelled.filter(F.col("cluster") != -1)
    n_clusters = real.select("cluster").distinct().count()
    row = (
        algorithm, n_clusters, counts["noise"], 100.0 * counts["noise"] / counts["n"] if counts["n"] else 0.0,
        silhouette(real) if n_clusters > 1 else None,
        None if with_noise else calinski_harabasz(real),
        None if with_noise else davies_bouldin(real),
    )
    return labelled.sparkSession.createDataFrame(
        [row], "algorithm string, n_clusters long, n_noise long, noise_percentage double, silhouette double, "
        "calinski_harabasz double, davies_bouldin double",
    )


def with_vectors(assigned: DataFrame, features: DataFrame) -> DataFrame:
    """(`id`, `vector`, `cluster`) for the metrics, on standardised features."""
    features = materialise(features)
    return standardise(features).join(assigned.select("id", "cluster"), "id")


def _merge_micro(centres: np.ndarray, sizes: np.ndarray, k: int, linkage: str) -> list[int]:
    """Agglomerate weighted centres down to `k` groups."""
    n = len(centres)
    gap = ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    w = sizes.astype(np.float64)
    if linkage == "ward":
        gap = gap * (w[:, None] * w[None, :] / (w[:, None] + w[None, :]))
    else:
        gap = np.sqrt(gap)
    np.fill_diagonal(gap, np.inf)
    alive, group = np.ones(n, dtype=bool), list(range(n))
    for _ in range(n - k):
        i, j = sorted(divmod(int(np.argmin(np.where(alive[:, None] & alive[None, :], gap, np.inf))), n))
        a, b = w[i], w[j]
        if linkage == "ward":
            new = ((a + w) * gap[i] + (b + w) * gap[j] - w * gap[i, j]) / (a + b + w)
        elif linkage == "average":
            new = (a * gap[i] + b * gap[j]) / (a + b)
        elif linkage == "complete":
            new = np.maximum(gap[i], gap[j])
        elif linkage == "single":
            new = np.minimum(gap[i], gap[j])
        else:
            raise ValueError(f"unknown linkage {linkage!r}")
        gap[i, :], gap[:, i] = new, new
        gap[i, i] = np.inf
        alive[j], w[i] = False, a + b
        group = [i if g == j else g for g in group]
    names = {g: c for c, g in enumerate(sorted(set(group), key=lambda g: centres[[x for x in range(n) if group[x] == g]].mean(axis=0).tolist()))}
    return [names[g] for g in group]


def hierarchical(features: DataFrame, k: int = 5, linkage: str = "ward", seed: int = 42, *, micro: int) -> DataFrame:
    """Agglomerative clustering of micro-clusters: (`id`, `cluster`, `feature_1`, `feature_2`).

    k-means forms at most `micro` small clusters over all rows, always, and their weighted centres are merged
    down to `k` groups. `micro` is part of the definition: the tree starts from these groups, not from single
    rows, at every size of the table. It is exact where every distinct vector is a micro-cluster of its own.
    """
    features = materialise(features)
    rows = standardise(features).select("id", as_doubles("vector").alias("vector")).repartition("id").sortWithinPartitions("id")  # one seed, one result
    data = materialise(rows).withColumn("features", array_to_vector("vector"))
    model = KMeans(k=micro, seed=seed, maxIter=20).fit(data)
    assigned = model.transform(data).select("id", F.col("prediction").alias("small"))
    size = {r["small"]: r["n"] for r in assigned.groupBy("small").agg(F.count(F.lit(1)).alias("n")).collect()}  # `micro` rows
    used = sorted(size)
    found = model.clusterCenters()
    centres = np.array([found[i] for i in used])
    labels = _merge_micro(centres, np.array([size[i] for i in used]), min(k, len(used)), linkage)
    names = F.create_map(*[F.lit(int(x)) for kv in zip(used, labels) for x in kv])
    return _assignment(assigned.withColumn("cluster", names[F.col("small")]), features)


def pca(features: DataFrame, n_components: int = 2) -> DataFrame:
    """(`id`, `components`): centred projection on the first principal axes, all rows."""
    rows = materialise(features.select("id", as_doubles("vector").alias("vector")))
    mean = rows.select(Summarizer.mean(array_to_vector("vector")).alias("m")).first()["m"].toArray()
    centred = rows.select("id", array_to_vector(F.zip_with("vector", _literal(mean), lambda x, c: x - c)).alias("features"))
    model = PCA(k=n_components, inputCol="features", outputCol="p").fit(centred)
    return model.transform(centred).select("id", vector_to_array("p").alias("components"))


def user_cluster_profile(assigned: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per cluster: users, reviews, rating mean and deviation, verified share in percent."""
    kept = assigned.filter(F.col("cluster") != -1).select(F.col("id").alias("user_id"), "cluster")
    size = kept.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    stats = reviews.join(kept, "user_id").groupBy("cluster").agg(
        F.avg("rating").alias("avg_rating"), F.stddev_samp("rating").alias("rating_std"), F.count(F.lit(1)).alias("total_reviews"),
        (F.avg(F.col("verified_purchase").cast("double")) * 100).alias("verified_purchase_pct"),
    )
    return size.join(stats, "cluster", "left").fillna(0, ["avg_rating", "rating_std", "total_reviews", "verified_purchase_pct"])


def product_cluster_profile(assigned: DataFrame, products: DataFrame, titles: int = 3) -> DataFrame:
    """Per cluster: products, price mean and range, rating mean, sample titles by lowest id."""
    kept = assigned.filter(F.col("cluster") != -1).select(F.col("id").alias("item_id"), "cluster")
    rows = products.join(kept, "item_id")
    stats = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.avg("price").alias("avg_price"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.avg("average_rating").alias("avg_rating"),
    )
    first = top_n_per_key(rows.select("cluster", "item_id", "title"), ["cluster"], [F.asc("item_id")], titles)
    lists = first.groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]).alias("sample_products")
    )
    return stats.join(lists, "cluster", "left")


def top_categories(assigned: DataFrame, rows: DataFrame, key: str, n: int = 3, category: str = "main_category") -> DataFrame:
    """Most frequent categories per cluster: `cluster`, `main_category`, `n`, `rank`."""
    kept = assigned.filter(F.col("cluster") != -1).select(F.col("id").alias(key), "cluster")
    counts = rows.join(kept, key).filter(F.col(category).isNotNull()).groupBy("cluster", category).agg(F.count(F.lit(1)).alias("n"))
    return top_n_per_key(counts, ["cluster"], [F.desc("n"), F.asc(category)], n)
