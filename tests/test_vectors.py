"""Dense neighbours, term features and clustering against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.functions.text import stem
from opinara.functions.vectors import l2_normalise, padded
from opinara.operators import cluster as CL
from opinara.operators import features as FE
from opinara.operators import knn
from opinara.operators.dbscan import connected_components, dbscan
from opinara.operators.knn import nearest_items, nearest_neighbours, search_cells
from opinara.operators.latent import latent_factors, latent_reduction
from opinara.operators.search import field_search, keyword_search
from opinara.operators.tfidf import tfidf


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vector array<double>").repartition(3)


def points(seed=0, n=90, d=5, copies=12):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) + rng.integers(0, 3, (n, 1)) * 3
    x[:copies] = x[0]
    return x


def brute(x, k, metric):
    out = {}
    for i in range(len(x)):
        if metric == "cosine":
            s = x @ x[i] / np.linalg.norm(x, axis=1) / np.linalg.norm(x[i])
        elif metric == "ip":
            s = x @ x[i]
        else:
            s = -((x - x[i]) ** 2).sum(axis=1)
        out[i] = [j for j in sorted(range(len(x)), key=lambda j: (-round(s[j], 9), j)) if j != i][:k]
    return out


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_exact_neighbours(spark, metric):
    x = points()
    got = {}
    for r in nearest_neighbours(table(spark, x), 7, metric=metric, n_pivots=9).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["neighbour_id"])
    assert got == brute(x, 7, metric)


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_exact_queries_travel_once_to_each_group(spark, metric, monkeypatch):
    """Cells that cannot be ruled out are visited in groups, in slices, with the same result."""
    x, sent, search = points(5, 120, 24, 4), [], knn.search_cells

    def counted(queries, items, *args):
        sent.append(queries.count())
        return search(queries, items, *args)

    monkeypatch.setattr(knn, "search_cells", counted)
    monkeypatch.setattr(knn, "GROUP", 50)
    monkeypatch.setattr(knn, "SLICE", 16)
    got = {}
    for r in nearest_neighbours(table(spark, x), 7, metric=metric, n_pivots=12).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["neighbour_id"])
    assert got == brute(x, 7, metric)
    assert sent[0] <= 120 and sent[1] <= 120 * 3  # three groups of at least 50 rows at most, not eleven cells


def test_distances_and_similarities_differ(spark):
    x = np.array([[1.0, 0.0], [0.0, 2.0], [1.0, 0.0]])
    rows = {(r["query_id"], r["neighbour_id"]): r for r in nearest_neighbours(table(spark, x), 2).collect()}
    assert rows[(0, 2)]["distance"] == 0.0 and rows[(0, 2)]["similarity"] == 1.0
    assert rows[(0, 1)]["distance"] == pytest.approx(math.sqrt(2), abs=1e-8)
    l2 = {(r["query_id"], r["neighbour_id"]): r["distance"] for r in nearest_neighbours(table(spark, x), 2, metric="l2").collect()}
    assert l2[(0, 1)] == 5.0


def test_chunks_do_not_change_cells(spark):
    x = points(3, 60, 3, 1)
    t = table(spark, x)
    q = t.select(F.lit(0).alias("cell"), F.col("id").alias("query"), F.col("vector").alias("qvec"))
    i = t.select(F.lit(0).alias("cell"), F.col("id").alias("item"), F.col("vector").alias("vec"))
    best = lambda c: {(r["query"], r["m"]) for r in search_cells(q, i, 1, "l2", c).groupBy("query").agg(F.max("score").alias("m")).collect()}
    assert best(7) == best(1000)


@pytest.mark.parametrize("method,options", [("ivf", {"n_cells": 8, "n_probe": 4}), ("lsh", {"tables": 12, "bits": 2})])
def test_approximate_recall(spark, method, options):
    x = points(5, 120, 6, 1)
    want = brute(x, 10, "cosine")
    got = {}
    for r in nearest_neighbours(table(spark, x), 10, method=method, **options).collect():
        got.setdefault(r["query_id"], set()).add(r["neighbour_id"])
    assert np.mean([len(got.get(i, set()) & set(want[i])) / 10 for i in want]) > 0.8


def test_foreign_queries(spark):
    x = points(7, 50, 4, 6)
    q = spark.createDataFrame([("a", [float(v) for v in x[0]])], "id string, vector array<double>")
    got = [r["neighbour_id"] for r in nearest_items(q, table(spark, x), 8, metric="l2", n_pivots=5).orderBy("rank").collect()]
    assert got == [0] + brute(x, 7, "l2")[0]


def test_vector_helpers(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    r = row.select(l2_normalise("a").alias("a"), l2_normalise("z").alias("z"), padded("a", 3).alias("p")).first()
    assert r["a"] == [0.6, 0.8] and r["z"] == [0.0, 0.0] and r["p"] == [3.0, 4.0, 0.0]


DOCS = ["red ring shine", "red ring", "blue plate", "red plate plate", "green", "red cup"]


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "id long, text string")
    rows = {(r["doc"], r["term"]): r for r in tfidf(docs, "id", "text", max_df=0.5).collect()}
    # "red" is in 4 of 6 documents, above max_df; only ring and plate and "red ring" are in two.
    assert {t for _, t in rows} == {"ring", "plate", "red ring"}
    assert rows[(3, "plate")]["tf"] == 2 and rows[(3, "plate")]["weight"] == pytest.approx(1.0)
    assert rows[(0, "ring")]["weight"] == pytest.approx(math.sqrt(0.5))
    assert {t for _, t in {(r["doc"], r["term"]): 1 for r in tfidf(docs, "id", "text", max_features=1).collect()}} == {"red"}
    every = tfidf(docs, "id", "text", ngrams=False, max_df=1.0, max_features=None).filter("doc = 0").collect()
    w = {r["term"]: r["weight"] for r in every}
    assert w["ring"] / w["red"] == pytest.approx((math.log(7 / 3) + 1) / (math.log(7 / 5) + 1))


def test_latent_reduction_keeps_cosines(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 8))) for i in range(25)], "id long, text string")
    f = tfidf(docs, "id", "text", ngrams=False, min_df=1, max_df=1.0)
    x = np.zeros((25, 12))
    for r in f.collect():
        x[r["doc"], words.index(r["term"])] = r["weight"]
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    want = x @ vt[:4].T
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    got = np.array([r["vector"] for r in latent_reduction(f, 4, passes=12).orderBy("doc").collect()])
    assert np.abs(got @ got.T - want @ want.T).max() < 0.05


def test_latent_factors_of_a_large_vocabulary(spark):
    rng = np.random.default_rng(5)
    n, terms, rank = 300, 3000, 12
    scale = 0.7 ** np.arange(rank)
    x = (np.linalg.qr(rng.standard_normal((n, rank)))[0] * scale) @ np.linalg.qr(rng.standard_normal((terms, rank)))[0].T
    x[np.abs(x) < np.quantile(np.abs(x), 0.9)] = 0  # sparse, of full rank again
    x[:, 7] = 1.0  # a term of every document
    x[3] = 0  # a document without weights
    at = [(int(i), f"t{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    f = spark.createDataFrame(at + [(3, "t0", None), (3, "t1", 0.0)], "doc long, term string, weight double").repartition(5)
    _, want, vt = np.linalg.svd(x, full_matrices=False)
    docs, values = latent_factors(f, 6, passes=8, entries=2000)
    assert np.allclose(values, want[:6], rtol=1e-4)
    rows = {r["doc"]: r["vector"] for r in docs.collect()}
    assert set(rows) == set(range(n)) - {3}
    got, best = np.array([rows[i] for i in sorted(rows)]), np.delete(x, 3, 0) @ vt[:6].T
    assert np.abs(got @ got.T - best @ best.T).max() < 1e-3
    # more directions than the matrix has: inner products are those of the weights
    few = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "b", 0.5), (3, "c", 1.0)], "doc long, term string, weight double")
    docs, values = latent_factors(few, 20, passes=2)
    rows = {r["doc"]: np.array(r["vector"]) for r in docs.collect()}
    assert len(values) == 3 and rows[1] @ rows[2] == pytest.approx(1.0) and rows[1] @ rows[3] == pytest.approx(0, abs=1e-9)
    docs, values = latent_factors(few.limit(0), 4)
    assert values == [] and docs.count() == 0 and latent_reduction(few.limit(0), 4).columns == ["doc", "vector"]


def test_latent_factors_keep_no_row_for_each_term(spark, monkeypatch):
    """The basis has a row for each document and is replaced in every pass; columns may travel in slices."""
    import opinara.operators.latent as L
    import opinara.session as session

    rng = np.random.default_rng(8)
    x = rng.standard_normal((25, 600)) * (rng.random((25, 600)) < 0.2)
    f = spark.createDataFrame([(f"d{i}", f"t{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))], "doc string, term string, weight double")
    kept, write = [], session.materialise

    def seen(df):
        kept.append(write(df))
        if "row" in df.columns:
            assert kept[-1].count() <= 25
        return kept[-1]

    monkeypatch.setattr(L, "materialise", seen)
    monkeypatch.setattr(L, "SIDE", 200)  # 25 documents in slices of a few columns
    before = len(session._WRITTEN)
    docs, values = latent_factors(f, 20, passes=4, entries=300)
    assert len(session._WRITTEN) - before <= 2 and len(kept) > 8
    want = np.linalg.svd(x, compute_uv=False)
    assert np.allclose(values, want[:20], rtol=1e-3)
    rows = {r["doc"]: np.array(r["vector"]) for r in docs.collect()}
    got = np.array([rows[f"d{i}"] for i in range(25)])
    assert np.allclose((got ** 2).sum(axis=0), np.square(values), rtol=1e-6)


def test_stems(spark):
    words = {"polishes": "polish", "polished": "polish", "polishing": "polish", "parties": "parti", "party": "parti", "stopped": "stop",
             "planning": "plan", "plates": "plat", "plate": "plat", "glass": "glass", "bus": "bus", "is": "is", "ring": "ring", "sing": "sing",
             "bed": "bed", "photos": "photo", "quickly": "quick", "happiness": "happi", "x1": "x1", "": ""}
    rows = spark.createDataFrame(list(words.items()), "w string, s string").select("w", "s", stem(F.col("w")).alias("got")).collect()
    assert {r["w"]: r["got"] for r in rows} == words
    assert all(r["w"].startswith(r["got"][:-1]) for r in rows)


def test_field_search_weighs_columns_and_meets_stems(spark):
    docs = spark.createDataFrame([
        (1, "Polished plates", "a set"), (2, "A set", "polished plates"), (3, "polish", None), (4, None, "plate"), (5, "boxes", "of the party"), (6, "", ""),
    ], "id long, title string, body string")
    find = lambda q, mode="all", **k: [r["doc"] for r in field_search(docs, "id", {"title": 2.0, "body": 1.0}, {"q": q}, mode, **k).collect()]
    assert find("polishing plate") == [1, 2]  # by stem only, the title counts more
    assert find("polishing box") == [] and set(find("polishing box", "any")) == {1, 2, 3, 5}
    assert find("box parties") == [5]  # one word in each column
    assert find("polishing", stems=False) == [] and find("polish", stems=False) == [3]
    assert find("...") == [] and find("nothing") == []
    assert field_search(docs.limit(0), "id", {"title": 1.0}, {"q": "plate"}).count() == 0
    with pytest.raises(ValueError):
        field_search(docs, "id", {"title": 0}, {"q": "plate"})


def test_bm25(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "id long, text string")
    got = keyword_search(docs, "id", "text", {"a": "red plate", "b": "Plate"}, "all").collect()
    assert {(r["query_id"], r["doc"], r["rank"]) for r in got} == {("a", 3, 1), ("b", 3, 1), ("b", 2, 2)}
    n, avg, df, tf, dl = 6, 13 / 6, 2, 2, 3
    want = math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg))
    assert next(r["score"] for r in got if r["query_id"] == "b" and r["doc"] == 3) == pytest.approx(want, abs=1e-8)
    assert keyword_search(docs, "id", "text", {"a": "red plate"}, "any").count() == 5
    with pytest.raises(ValueError):
        keyword_search(docs, "id", "text", {"a": "x"}, "other")


def test_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id long, a double, b double")
    assert [tuple(r) for r in FE.min_max_scaled(df, ["a", "b"]).orderBy("id").collect()] == [(1, 0.0, 5.0), (2, 1.0, 5.0)]
    assert [tuple(r) for r in FE.z_scored(df, ["a", "b"], sample=False).orderBy("id").collect()] == [(1, -1.0, 0.0), (2, 1.0, 0.0)]
    z = CL.standardise(FE.as_vector(df, "id", ["a", "b"])).orderBy("id").collect()
    assert [r["vector"] for r in z] == [[-1.0, 0.0], [1.0, 0.0]]


def test_metadata_and_hybrid(spark):
    p = spark.createDataFrame(
        [(1, 10.0, "x", 4.0, 2000, "a long description", ["f"]), (2, None, None, None, None, "short", [""])],
        "item_id long, price double, main_category string, average_rating double, rating_number int, description string, features array<string>",
    )
    m = {r["item_id"]: r for r in FE.metadata_features(p).collect()}
    assert (m[1]["price"], m[1]["rating_count"], m[1]["has_description"], m[1]["has_features"]) == (1.0, 1.0, 1.0, 1.0)
    assert (m[2]["price"], m[2]["avg_rating"], m[2]["has_features"]) == (0.0, 0.0, 0.0)
    row = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0, 9.0], [1.0])], "t array<double>, e array<double>, m array<double>")
    h = row.select(FE.hybrid_weighted("t", "e", "m", 2).alias("h")).first()["h"]
    assert h == pytest.approx(np.array([0.5, 0, 0, 0.4, 0.1, 0]) / np.linalg.norm([0.5, 0.4, 0.1]))


def test_user_texts_cut(spark):
    rows = [(1, i, "t", "x" * 7) for i in range(400)] + [(2, 0, None, None)]
    df = spark.createDataFrame(rows, "user_id long, n int, title string, text string")
    got = {r["user_id"]: r["combined_text"] for r in FE.user_texts(df, ["n"], max_chars=25).collect()}
    assert got == {1: ("t. xxxxxxx " * 3)[:25], 2: ". "}


def test_text_encoder_batches(spark):
    df = spark.createDataFrame([(i, "a" * i) for i in range(5)], "id long, text string")
    got = {r["id"]: r["vector"] for r in FE.text_embeddings(df, "id", "text", lambda ts: [[float(len(t)), 0.0] for t in ts], batch=2).collect()}
    assert got[0] == [0.0, 0.0] and got[4] == [1.0, 0.0]
    assert len(FE.text_embeddings(df, "id", "text", dim=16).first()["vector"]) == 16


def labelled(spark, x, labels):
    return spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, labels))], "id long, vector array<double>, cluster int")


def test_quality_by_hand(spark):
    x, c = np.array([[0.0, 0], [0, 2], [10, 0], [10, 2]]), [0, 0, 1, 1]
    df = labelled(spark, x, c)
    a, b = 4, (100 + 104) / 2  # mean squared distances to the own and to the other cluster
    assert CL.silhouette(df) == pytest.approx((b - a) / b)
    assert CL.calinski_harabasz(df) == pytest.approx(100 * 2 / 4)
    assert CL.davies_bouldin(df) == pytest.approx(0.2)
    assert CL.silhouette(labelled(spark, x, [0] * 4)) == -1.0 and CL.calinski_harabasz(labelled(spark, x, [0] * 4)) is None


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r["cluster"], set()).add(r["id"])
    return {frozenset(v) for v in out.values()}


def three_blobs(seed=4):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.standard_normal((20, 2)) * 0.2 + c for c in ([0, 0], [6, 0], [0, 6])])


def test_kmeans_and_choice_of_k(spark):
    df = table(spark, three_blobs())
    out = CL.kmeans(df, max_k=5, starts=3).collect()
    assert groups(out) == {frozenset(range(20)), frozenset(range(20, 40)), frozenset(range(40, 60))}
    curve = CL.choose_k(CL.standardise(df), 4, starts=3).orderBy("k").collect()
    assert [r["inertia"] for r in curve] == sorted((r["inertia"] for r in curve), reverse=True)
    again = CL.kmeans(df.repartition(7), 3, starts=3).collect()
    assert {r["id"]: r["cluster"] for r in out} == {r["id"]: r["cluster"] for r in again}
    report = CL.run_report("kmeans", CL.with_vectors(CL.kmeans(df, 3, starts=2), df)).first()
    assert report["n_clusters"] == 3 and report["silhouette"] > 0.8


@pytest.mark.parametrize("linkage", ["ward", "average", "complete", "single"])
def test_hierarchical(spark, linkage):
    df = table(spark, three_blobs())
    want = {frozenset(range(20)), frozenset(range(20, 40)), frozenset(range(40, 60))}
    assert groups(CL.hierarchical(df, 3, linkage, micro=60).collect()) == want
    assert groups(CL.hierarchical(df, 3, linkage, micro=12).collect()) == want


def test_pca(spark):
    x = points(9, 40, 4, 1)
    got = np.array([r["components"] for r in CL.pca(table(spark, x), 2).orderBy("id").collect()])
    c = x - x.mean(axis=0)
    want = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)


def brute_dbscan(x, eps, m):
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= m
    label = np.full(len(x), -1)
    c = 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack, label[i] = [i], c
            while stack:
                p = stack.pop()
                for q in np.flatnonzero(near[p] & core):
                    if label[q] < 0:
                        label[q] = c
                        stack.append(q)
            c += 1
    for i in np.flatnonzero(~core):
        reach = label[near[i] & core]
        if len(reach):
            label[i] = reach.min()
    return label


@pytest.mark.parametrize("d,eps", [(1, 0.05), (2, 0.35), (3, 0.6), (5, 1.2)])
def test_dbscan(spark, d, eps):
    rng = np.random.default_rng(d)
    x = np.concatenate([rng.standard_normal((40, d)) * 0.3, rng.standard_normal((30, d)) * 0.3 + 2, rng.uniform(-3, 5, (25, d))])
    x[:9] = x[0]
    x = np.round(x, 3)
    got = {r["id"]: r["cluster"] for r in dbscan(table(spark, x), eps, 5, scale=False).collect()}
    assert [got[i] for i in range(len(x))] == brute_dbscan(x, eps, 5).tolist()


def test_dbscan_in_many_dimensions(spark, monkeypatch):
    import opinara.operators.dbscan as D

    monkeypatch.setattr(D, "CHUNK", 40)  # so that rings and full cells are cut
    rng = np.random.default_rng(16)
    near = lambda n, at, width: at + rng.standard_normal((n, 16)) * width
    x = np.concatenate([
        0.5 + rng.uniform(-0.01, 0.01, (150, 16)),  # a third of all rows in one cell
        near(60, 0.52, 0.05), near(80, 2.0, 0.08), np.linspace(2.0, 4.0, 40)[:, None] * np.ones(16), rng.uniform(-1, 5, (60, 16)),
    ])
    x = np.round(x[rng.permutation(len(x))], 3)
    want = brute_dbscan(x, 0.6, 5)
    assert len(set(want)) > 2 and -1 in want
    for pivots in (1, 9):
        got = {r["id"]: r["cluster"] for r in dbscan(table(spark, x), 0.6, 5, scale=False, pivots=pivots).collect()}
        assert [got[i] for i in range(len(x))] == want.tolist()


def test_cells_meet_by_pivots_as_by_the_grid(spark):
    from opinara.operators.dbscan import _grid_pairs, _pivot_pairs

    at = {tuple(float(v) for v in r) for r in np.random.default_rng(3).integers(-6, 7, (150, 3))}
    cells = spark.createDataFrame([(",".join(map(str, a)), list(a)) for a in at], "cell string, at array<double>")
    side = 0.5 / math.sqrt(3)
    by = lambda df: sorted(map(tuple, df.collect()))
    assert by(_pivot_pairs(cells, side, 0.5, 3, 7)) == by(_grid_pairs(cells, side, 0.5, 3))


def test_dbscan_searches_few_pairs_of_full_cells(spark, monkeypatch):
    """Full cells whose single points already join them are not searched whole; constant coordinates cost no cells."""
    import opinara.operators.dbscan as D

    searched, linked, cut = [], D._linked_dense, D._pivot_pairs
    monkeypatch.setattr(D, "_linked_dense", lambda pairs, *rest: searched.append(pairs.count()) or linked(pairs, *rest))
    seen = []
    monkeypatch.setattr(D, "_pivot_pairs", lambda cells, side, eps, dims, pivots: seen.append(dims) or cut(cells, side, eps, dims, pivots))
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.uniform(0, 1, (1500, 4)), rng.uniform(0, 1, (300, 4)) + [1.8, 0, 0, 0], rng.uniform(4, 9, (30, 4))])
    x = np.round(np.concatenate([x[:, :2], np.full((len(x), 2), 7.0), x[:, 2:]], axis=1), 3)
    got = {r["id"]: r["cluster"] for r in dbscan(table(spark, x), 0.6, 4, scale=False).collect()}
    want = brute_dbscan(x, 0.6, 4)
    assert [got[i] for i in range(len(x))] == want.tolist() and len(set(want)) > 2
    assert seen == [4] and searched[0] < 40


def test_dbscan_all_noise(spark):
    x = np.array([[0.0, 0], [5, 5], [9, 0]])
    assert {r["cluster"] for r in dbscan(table(spark, x), 0.5, 2, scale=False).collect()} == {-1}


def test_long_chain_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 100, 101, 200]], "node long")
    got = {r["node"]: r["component"] for r in connected_components(nodes, edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}


def test_cluster_profiles(spark):
    assigned = spark.createDataFrame([(1, 0), (2, 0), (3, -1)], "id long, cluster int")
    reviews = spark.createDataFrame([(1, 5, True), (2, 4, False), (3, 1, True)], "user_id long, rating int, verified_purchase boolean")
    r = CL.user_cluster_profile(assigned, reviews).collect()
    assert len(r) == 1 and (r[0]["size"], r[0]["avg_rating"], r[0]["verified_purchase_pct"]) == (2, 4.5, 50.0)
    products = spark.createDataFrame([(1, "a", 2.0, 4.0, "x"), (2, "b", None, 2.0, "x")], "item_id long, title string, price double, average_rating double, main_category string")
    p = CL.product_cluster_profile(assigned, products).first()
    assert (p["size"], p["avg_price"], p["avg_rating"], p["sample_products"]) == (2, 2.0, 3.0, ["a", "b"])
    assert [tuple(x) for x in CL.top_categories(assigned, products, "item_id").select("main_category", "n").collect()] == [("x", 2)]


def test_reports_read_their_features_a_few_times(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = [(i, [float(i % 2) * 9 + i / 100, float(i % 5)]) for i in range(40)]
    features = spark.createDataFrame(rows, "id long, vector array<double>").mapInPandas(look, "id long, vector array<double>")
    CL.run_report("kmeans", CL.with_vectors(CL.kmeans(features, 2), features)).collect()
    CL.run_report("ward", CL.with_vectors(CL.hierarchical(features, 2, micro=8), features)).collect()
    assert seen.value <= 4 * len(rows)  # one pass for each clustering and each report


def test_word_vectors_train_in_parts(spark, monkeypatch):
    from pyspark.ml.feature import Word2Vec

    asked, fit = [], Word2Vec.fit
    monkeypatch.setattr(Word2Vec, "fit", lambda self, rows: asked.append(self.getNumPartitions()) or fit(self, rows))
    docs = spark.createDataFrame([(i, f"red car w{i % 3} blue") for i in range(45)], "id long, text string")
    assert FE.word_vectors(docs, "id", "text", dim=4).count() == 45
    assert FE.word_vectors(docs, "id", "text", dim=4, part_rows=20).count() == 45
    assert asked == [1, 3]


def test_latent_factors_hold_few_numbers_at_once(spark, monkeypatch):
    """Rows leave a task some documents at a time, and the first signs stay bits, whatever the number of documents and terms of a block."""
    import opinara.operators.latent as L

    rng = np.random.default_rng(12)
    x = rng.random((40, 90)) * (rng.random((40, 90)) < 0.3)
    f = spark.createDataFrame([(int(d), f"t{t}", float(x[d, t])) for d, t in np.argwhere(x)], "doc long, term string, weight double")
    sizes, lists = spark.sparkContext.accumulator(0), L._lists

    def counted(rows, kind):
        if kind == pa.float32() and rows.size > 80:
            sizes.add(1)
        return lists(rows, kind)

    monkeypatch.setattr(L, "_lists", counted)
    monkeypatch.setattr(L, "PIECE", 80)
    matrix = L._Matrix(f, 15, 1 << 22)
    assert all(len(r["sign"]) == 2 * len(r["n"]) for r in matrix.blocks.collect())
    started = {r["d"]: r["row"] for r in matrix.started(15).collect()}
    assert len(started) == 40 and not sizes.value
    docs, values = latent_factors(f, 40, passes=2)
    assert np.allclose(values, np.linalg.svd(x, compute_uv=False)[:len(values)], rtol=1e-5) and docs.count() == 40
