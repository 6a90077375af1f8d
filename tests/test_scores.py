"""Blocked top scores against dense products."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import graph as G
from opinara.operators import recommend as R
from opinara.operators import scores as SC
from opinara.operators import similarity as SIM


def ranked(df, a="query", b="item", score="score"):
    out = defaultdict(list)
    for r in df.select(a, b, score, "rank").orderBy(a, "rank").collect():
        out[r[a]].append((r[b], r[score]))
    return dict(out)


def dense_top(q, x, k, gone=None):
    """Best k columns of q @ x.T for each row, ties to the lower index."""
    s = np.floor(q @ x.T * 1e9 + 0.5) / 1e9
    if gone is not None:
        s[gone] = 0
    out = {}
    for i, row in enumerate(s):
        order = np.lexsort((np.arange(len(row)), -row))[:k]
        mine = [(int(j), row[j]) for j in order if row[j] > 0]
        if mine:
            out[i] = mine
    return out


def same(got, want):
    assert set(got) == set(want)
    for k in want:
        assert [i for i, _ in got[k]] == [i for i, _ in want[k]], k
        assert [s for _, s in got[k]] == pytest.approx([s for _, s in want[k]], abs=2e-9)


def sparse(spark, m, names):
    at = np.argwhere(m)
    rows = [(int(i), int(j), float(m[i, j])) for i, j in at]
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, ("long", "long", "double"), strict=True)))


def skewed_matrix(rng, rows, dims, share, weights):
    """Dimension 0 holds a third of all entries, dimension d the share of 1/d of the rest."""
    m = np.zeros((rows, dims))
    p = np.minimum(1, share / np.arange(1, dims + 1))
    hit = rng.random(m.shape) < p
    hit[:, 0] = rng.random(rows) < 0.9
    m[hit] = rng.choice(weights, hit.sum())
    return m


@pytest.mark.parametrize("weights", [[1.0], [0.5, 1.0, 3.0], list(np.linspace(0.01, 2, 500))])
@pytest.mark.parametrize("hot_limit, entries", [(10_000, 4_000_000), (100, 4_000_000), (100, 3000), (20, 200)])
def test_scores_equal_dense_products(spark, weights, hot_limit, entries):
    rng = np.random.default_rng(len(weights) + hot_limit)
    x, q = skewed_matrix(rng, 800, 60, 0.5, weights), skewed_matrix(rng, 90, 60, 0.8, weights)
    q[7], x[13] = 0, 0
    gone = rng.random((90, 800)) < 0.1
    gone[3] = True
    got = SC.top_scores(sparse(spark, q, ("query", "dim", "qw")), sparse(spark, x, ("item", "dim", "iw")), 6,
                        sparse(spark, gone, ("query", "item", "n")).select("query", "item"), hot_limit, first_depth=30, block_entries=entries)
    same(ranked(got), dense_top(q, x, 6, gone))


def test_text_keys_nulls_and_nothing(spark):
    q = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 2.0), ("v", None, 1.0), (None, "a", 1.0), ("w", "zz", 1.0)], "query string, dim string, qw double")
    x = spark.createDataFrame([("é", "a", 2.0), ("b", "a", 2.0), ("c", "b", 1.0), ("d", None, 9.0), (None, "a", 9.0)], "item string, dim string, iw double")
    gone = spark.createDataFrame([("u", "c"), ("u", None), ("nobody", "b")], "query string, item string")
    assert ranked(SC.top_scores(q, x, 3)) == {"u": [("b", 2.0), ("c", 2.0), ("é", 2.0)]}
    assert ranked(SC.top_scores(q, x, 3, gone)) == {"u": [("b", 2.0), ("é", 2.0)]}
    for a, b in ((q.limit(0), x), (q, x.limit(0)), (q.limit(0), x.limit(0))):
        assert SC.top_scores(a, b, 3, gone).count() == 0


def test_a_hot_dimension_of_a_large_table(spark):
    """200,000 rows, one dimension in a third of them: exact, and no query's block holds the whole dimension."""
    rng = np.random.default_rng(2)
    n = 66_000
    dims = np.concatenate([np.zeros(n, int), rng.integers(1, 40_000, 2 * n)])
    items = np.concatenate([np.arange(n), np.repeat(np.arange(n), 2)])
    weight = np.round(rng.random(3 * n) + 0.01, 3)
    keep = np.unique(np.stack([items, dims]), axis=1, return_index=True)[1]
    items, dims, weight = items[keep], dims[keep], weight[keep]
    x = spark.createDataFrame([(int(i), int(d), float(w)) for i, d, w in zip(items, dims, weight, strict=True)], "item long, dim long, iw double")
    q = spark.createDataFrame([(i, 0, 1.0) for i in range(40)] + [(i, 100 + i, 0.5) for i in range(40)], "query long, dim long, qw double")
    got = ranked(SC.top_scores(q, x, 10, hot_limit=2000, block_entries=20_000))
    whole = np.zeros(n)
    np.add.at(whole, items[dims == 0], weight[dims == 0])
    for i in range(40):
        s = whole.copy()
        at = dims == 100 + i
        np.add.at(s, items[at], 0.5 * weight[at])
        s = np.floor(s * 1e9 + 0.5) / 1e9
        order = np.lexsort((np.arange(n), -s))[:10]
        assert [j for j, _ in got[i]] == order.tolist()


@pytest.mark.parametrize("hot_limit", [10, 1000])
def test_cosine_of_terms(spark, hot_limit):
    rng = np.random.default_rng(6)
    x = skewed_matrix(rng, 150, 40, 0.6, [1.0, 2.0, 5.0])
    x[20] = x[21]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    got = ranked(SIM.similar_by_terms(sparse(spark, x, ("doc", "term", "weight")), 5, hot_limit), "query_id", "neighbour_id", "similarity")
    want = {}
    for i in range(150):
        one = dense_top(x[i:i + 1], x, 6)
        if one:
            want[i] = [(j, s) for j, s in one[0] if j != i][:5]
    for i, mine in want.items():
        # equal vectors come from one class, so that sums may differ in the last digit
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in mine], abs=2e-9)
        assert len({j for j, _ in got[i]} ^ {j for j, _ in mine}) == 0 or mine[-1][1] == pytest.approx(got[i][-1][1], abs=2e-9)


@pytest.mark.parametrize("hot_limit", [3, 15, 1000])
def test_item_based_without_an_item_matrix(spark, hot_limit):
    """Busy users, popular items and users who like nothing."""
    rng = np.random.default_rng(hot_limit)
    r = np.zeros((80, 50))
    hit = rng.random(r.shape) < 0.12
    hit[:, :2], hit[:3] = rng.random((80, 2)) < 0.8, rng.random((3, 50)) < 0.7
    r[hit] = rng.integers(1, 6, hit.sum())
    r[9] = np.minimum(r[9], 2)
    unit = r / np.maximum(np.linalg.norm(r, axis=0), 1e-12)
    sim, liked = unit.T @ unit, np.where(r > 3, r, 0)
    s = liked @ sim / np.maximum((r > 3).sum(axis=1, keepdims=True), 1)
    want = dense_top(np.where(r > 0, 0, s), np.eye(50), 4)
    at = np.argwhere(r)
    ratings = spark.createDataFrame([(int(u), int(i), float(r[u, i])) for u, i in at], "user_id long, item_id long, rating double")
    same(ranked(R.recommend_item_based(ratings, 4, hot_limit), "user_id", "item_id"), want)


def test_cosines_of_a_hot_key(spark):
    """200,000 ratings, one item rated by a third of all rows: equal to dense cosines for the users asked about, in bounded blocks."""
    rng = np.random.default_rng(12)
    n = 66_000
    users = np.concatenate([np.arange(n), np.repeat(np.arange(n), 2)])
    items = np.concatenate([np.zeros(n, int), rng.integers(1, 50_000, 2 * n)])
    stars = rng.integers(1, 6, 3 * n).astype(float)
    keep = np.unique(np.stack([users, items]), axis=1, return_index=True)[1]
    users, items, stars = users[keep], items[keep], stars[keep]
    norms = np.sqrt(np.bincount(users, stars * stars))
    edges = spark.createDataFrame([(int(u), int(i), float(r), float(norms[u])) for u, i, r in zip(users, items, stars, strict=True)], "item long, dim long, iw double, norm double")
    asked = edges.filter("item % 1100 = 7").selectExpr("item AS query", "dim", "iw AS qw")
    got = ranked(SC.top_scores(asked, edges, 8, asked.selectExpr("query", "query AS item").distinct(), 2000, None))
    assert len(got) == 60
    for u in got:
        dot = np.zeros(n)
        for i, r in zip(items[users == u], stars[users == u], strict=True):
            dot[users[items == i]] += r * stars[items == i]
        dot[u] = 0
        key = np.rint(dot * 1e9) / 1e9 / (np.rint(norms * 1e9) / 1e9)
        assert [j for j, _ in got[u]] == np.lexsort((np.arange(n), -key))[:8].tolist()


@pytest.mark.parametrize("multi", [False, True])
def test_shared_reviewers_of_a_hot_user(spark, multi):
    """Path counts are pruned by the largest number of paths an item has; the result is that of plain counting."""
    rng = np.random.default_rng(3)
    c = rng.poisson(0.25, (40, 60)) * (rng.random((40, 60)) < 0.4)
    c[0] = rng.integers(1, 4, 60)
    rows = [(u, i, 5, t) for u, i in np.argwhere(c).tolist() for t in range(int(c[u, i]))]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int, ts long")
    m = c if multi else (c > 0).astype(int)
    shared = m.T @ m
    np.fill_diagonal(shared, 0)
    got = ranked(G.shared_reviewers(df, 4, multi, hot_limit=10), "item_id", "similar_item", "shared_reviewers")
    same(got, dense_top(shared.astype(float), np.eye(60), 4))


@pytest.mark.parametrize("hot_limit", [4, 1000])
def test_hybrid_without_pools(spark, hot_limit):
    """An item far down both lists keeps both parts."""
    rng = np.random.default_rng(5)
    r = np.zeros((30, 70))
    hit = rng.random(r.shape) < 0.15
    r[hit] = rng.integers(1, 6, hit.sum())
    r[np.arange(30), np.arange(30)] = 5
    x = skewed_matrix(rng, 70, 12, 0.9, [1.0, 2.0, 3.0])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    unit = r / np.linalg.norm(r, axis=1, keepdims=True)
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    near = np.zeros_like(cosine)
    for u in range(30):
        best = np.lexsort((np.arange(30), -cosine[u]))[:7]
        near[u, best] = np.floor(cosine[u, best] * 1e9 + 0.5) / 1e9
    liked = ((r >= 4) & x.any(axis=1)).astype(float)  # items without terms are not in the model
    profile = liked @ x / np.maximum(liked.sum(axis=1, keepdims=True), 1)
    score = 0.6 * (near / near.sum(axis=1, keepdims=True)) @ r + 0.4 * profile @ x.T
    want = dense_top(np.where(r > 0, 0, score), np.eye(70), 60)
    reviews = spark.createDataFrame([(int(u), int(i), int(r[u, i]), 0) for u, i in np.argwhere(r)], "user_id long, item_id long, rating int, ts long")
    features = sparse(spark, x, ("item_id", "n", "weight")).selectExpr("item_id", "cast(n as string) AS term", "weight")
    same(ranked(R.recommend_hybrid_complete(reviews, features, 0.6, 60, 7, hot_limit), "user_id", "item_id"), want)


@pytest.mark.parametrize("named", [False, True])
@pytest.mark.parametrize("digits", [9, None])
def test_whole_items_meet_in_tiles(spark, named, digits, monkeypatch):
    """Many queries against many items: every weight goes once to each block or chunk, whatever the number of products."""
    rng = np.random.default_rng(4)
    x, q = skewed_matrix(rng, 300, 40, 0.8, [0.5, 1.0, 3.0]), skewed_matrix(rng, 250, 40, 0.8, [0.5, 1.0, 2.0])
    gone = rng.random((250, 300)) < 0.1
    tiled, sent = SC._tiled, []

    def counted(*args):
        sent.append(args[-3:-1])
        return tiled(*args)

    monkeypatch.setattr(SC, "_tiled", counted)
    monkeypatch.setattr(SC, "PACK", 64)
    monkeypatch.setattr(SC, "BLOCK_ROWS", 3000)
    queries, items = sparse(spark, q, ("query", "dim", "qw")), sparse(spark, x, ("item", "dim", "iw"))
    if named:
        queries, items = (df.withColumn("dim", df["dim"].cast("string")) for df in (queries, items))
    if digits is None:
        norms = spark.createDataFrame([(i, float(np.sqrt((r * r).sum()))) for i, r in enumerate(x)], "item long, norm double")
        items = items.join(norms, "item")
    got = SC.top_scores(queries, items, 6, sparse(spark, gone, ("query", "item", "n")).select("query", "item"), digits=digits, block_entries=500)
    assert sent and sent[0][0] == np.count_nonzero(x)
    if digits is not None:
        return same(ranked(got), dense_top(q, x, 6, gone))
    scores = q @ x.T
    scores[gone] = 0
    norm = np.round(np.sqrt((x * x).sum(axis=1)), 9)
    for i, found in ranked(got).items():
        keys = np.round(scores[i], 9) / norm
        assert [j for j, _ in found] == [int(j) for j in np.lexsort((np.arange(300), -keys)) if keys[j] > 0][:6]


def test_excluded_pairs_go_to_one_tile(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x, q = skewed_matrix(rng, 300, 40, 0.8, [0.5, 1.0, 3.0]), skewed_matrix(rng, 250, 40, 0.8, [0.5, 1.0, 2.0])
    gone = rng.random((250, 300)) < 0.1
    seen, block = spark.sparkContext.accumulator(0), SC._score_block

    def counted(*args):
        score = block(*args)

        def run(asked, lists):
            seen.add(len(asked["item"].drop_null()))
            return score(asked, lists)

        return run

    monkeypatch.setattr(SC, "_score_block", counted)
    monkeypatch.setattr(SC, "BLOCK_ROWS", 3000)
    got = SC.top_scores(sparse(spark, q, ("query", "dim", "qw")), sparse(spark, x, ("item", "dim", "iw")), 6,
                        sparse(spark, gone, ("query", "item", "n")).select("query", "item"), block_entries=500)
    same(ranked(got), dense_top(q, x, 6, gone))
    assert seen.value == gone[q.any(axis=1)].sum()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_blocks_take_turns_and_keep_only_the_best(spark, kind, monkeypatch):
    """A few blocks at a time meet the items, which pass by in pieces; what a turn shuffles is bounded, ties go to the lower item."""
    rng = np.random.default_rng(8)
    x, q = skewed_matrix(rng, 400, 30, 0.8, [1.0, 2.0]), skewed_matrix(rng, 200, 30, 0.8, [1.0, 2.0])
    gone = rng.random((200, 400)) < 0.1
    turns, write = [], SC.materialise

    def counted(df, settings=None):
        turns.extend([settings] if settings else [])
        return write(df, settings)

    monkeypatch.setattr(SC, "materialise", counted)
    for name, value in (("PACK", 100), ("SLICE", 500), ("KEPT", 300), ("BLOCK_BEST", 60), ("TILE_ENTRIES", 1000)):
        monkeypatch.setattr(SC, name, value)
    items = sparse(spark, x, ("item", "dim", "iw")).withColumn("item", F.format_string("%03d", "item").cast(kind))
    out = sparse(spark, gone, ("query", "item", "n")).select("query", F.format_string("%03d", "item").cast(kind).alias("item"))
    got = SC.top_scores(sparse(spark, q, ("query", "dim", "qw")), items, 6, out, block_entries=1000).withColumn("item", F.col("item").cast("long"))
    same(ranked(got), dense_top(q, x, 6, gone))
    assert len(turns) > 3
