"""Models that advance together against plain Lloyd iterations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import cluster as CL
from opinara.operators import kmeans as KM


def table(spark, x, parts=3):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, vector array<double>").repartition(parts).select(F.xxhash64("id").alias("ticket"), "vector")


def plain(x, centres, tolerance=KM.TOLERANCE):
    limit = tolerance * x.var(axis=0).mean()
    for _ in range(KM.MAX_ITER):
        at = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[at == c].mean(axis=0) if (at == c).any() else centres[c] for c in range(len(centres))])
        step, centres = ((new - centres) ** 2).sum(), new
        if step <= limit:
            break
    d = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    return centres[np.lexsort(centres.T[::-1])], d.min(axis=1).sum()


def cloud(seed=1, n=240, d=3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, d)) + rng.integers(0, 4, (n, 1)) * 1.5


def test_all_models_equal_single_ones(spark):
    x = cloud()
    data = table(spark, x).cache()
    seeds = KM.seed_centres(data, 6, 3, 5)
    assert all(c.shape == (6, 3) and len(np.unique(c, axis=0)) == 6 for c in seeds)
    models = KM.fit_models(data, [2, 4, 6], 3, 5)
    assert len(models) == 9
    for m in models:
        centres, cost = plain(x, seeds[m.start][:m.k])
        assert np.allclose(m.centres, centres) and m.inertia == pytest.approx(cost)
    best = KM.best_models(models)
    assert {k: m.inertia for k, m in best.items()} == {k: min(m.inertia for m in models if m.k == k) for k in (2, 4, 6)}


def test_draws_do_not_depend_on_partitions(spark):
    x = cloud(2)
    a, b = (KM.seed_centres(table(spark, x, p), 4, 2, 9) for p in (1, 6))
    assert all((p == q).all() for p, q in zip(a, b, strict=True))


def test_draws_follow_squared_distances(spark):
    """A far group of one row in fifty is drawn second almost always; equal rows give one centre only."""
    x = np.concatenate([np.random.default_rng(0).standard_normal((98, 2)) * 0.01, np.full((2, 2), 100.0)])
    seeds = KM.seed_centres(table(spark, x), 2, 12, 1)
    assert sum(abs(c[0, 0] - c[1, 0]) > 50 for c in seeds) == 12
    assert [len(c) for c in KM.seed_centres(table(spark, np.ones((5, 2))), 3, 2, 1)] == [1, 1]


def test_silhouettes_of_all_models(spark):
    x = cloud(3)
    features = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vector array<double>")
    curve = CL.choose_k(features, 5, starts=2).orderBy("k").collect()
    data = CL._prepared(features)
    for row in curve:
        m = KM.best_models(KM.fit_models(data.select("ticket", "vector"), [row["k"]], 2, 42))[row["k"]]
        labelled = KM.assign(data.select("id", "vector"), m.centres)
        assert row["inertia"] == pytest.approx(m.inertia) and row["silhouette"] == pytest.approx(CL.silhouette(labelled))


def test_few_and_no_rows(spark):
    features = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0])], "id long, vector array<double>")
    assert {r["cluster"] for r in CL.kmeans(features, 3, starts=2).collect()} == {0}
    assert CL.kmeans(features.limit(0), 3, starts=2).count() == 0
    assert KM.fit_models(table(spark, np.empty((0, 2))), [2], 2, 1) == []
