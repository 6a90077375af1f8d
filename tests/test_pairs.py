"""Partner and score operators against brute force, with and without hot keys."""

import random
from collections import defaultdict
from math import sqrt

import pytest

from opinara.operators import graph as G
from opinara.operators import recommend as R
from opinara.operators import scores as SC
from opinara.operators import similarity as SIM


def skewed(seed, users=24, items=14, extra=60):
    """Item 0 is rated by nearly everybody, user 0 rates nearly everything."""
    rng = random.Random(seed)
    rows = {}
    for u in range(users):
        if rng.random() < 0.9:
            rows[(u, 0)] = rng.randint(1, 5)
        if rng.random() < 0.5:
            rows[(u, 1)] = rng.randint(1, 5)
    for i in range(items):
        rows[(0, i)] = rng.randint(1, 5)
    for _ in range(extra):
        rows[(rng.randrange(users), rng.randrange(items))] = rng.randint(1, 5)
    return [(u, i, r, 0) for (u, i), r in rows.items()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int, ts long")


def by(rows, a, b):
    out = defaultdict(dict)
    for r in rows:
        out[r[a]][r[b]] = float(r[2])
    return out


def cosine_lists(vectors, k):
    n = {x: sqrt(sum(v * v for v in d.values())) for x, d in vectors.items()}
    out = {}
    for x, d in vectors.items():
        s = []
        for y, e in vectors.items():
            dot = sum(v * e[i] for i, v in d.items() if i in e)
            if x != y and dot > 0:
                s.append((-round(dot / (n[y] * n[x]), 9), y))
        out[x] = [(y, -s_) for s_, y in sorted(s)[:k]]
    return out


def lists(df, a, b, c):
    out = defaultdict(list)
    for r in df.orderBy(a, "rank").collect():
        out[r[a]].append((r[b], r[c]))
    return out


def close(got, want):
    assert set(got) == {k for k, v in want.items() if v}
    for k in got:
        assert [x for x, _ in got[k]] == [x for x, _ in want[k]], k
        assert [s for _, s in got[k]] == pytest.approx([s for _, s in want[k]], abs=1e-6)


@pytest.mark.parametrize("hot_limit", [3, 10, 1000])
def test_cosine_neighbours(spark, hot_limit):
    rows = skewed(1)
    ratings = R.rating_matrix(frame(spark, rows))
    got = lists(R.cosine_neighbours(ratings, 5, hot_limit=hot_limit), "user_id", "neighbour", "similarity")
    close(got, cosine_lists(by(rows, 0, 1), 5))


@pytest.mark.parametrize("hot_limit", [1000, 2])
def test_cosine_ties_do_not_depend_on_the_hot_limit(spark, hot_limit):
    rows = [(100, 0, 1.0), (100, 9, 100.0), (1, 0, 1.0), (1, 11, 1.00000005), (2, 0, 1.0), (2, 12, 1.0), (3, 0, 1.0), (3, 13, 1.0)]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    got = {r["user_id"]: r["neighbour"] for r in R.cosine_neighbours(ratings, 1, hot_limit=hot_limit).collect()}
    assert got == {100: 2, 1: 2, 2: 3, 3: 2}


def test_item_neighbours_with_hot_user(spark):
    rows = skewed(2)
    ratings = R.rating_matrix(frame(spark, rows))
    got = lists(R.cosine_neighbours(ratings, 4, entity="item_id", key="user_id", hot_limit=4), "item_id", "neighbour", "similarity")
    close(got, cosine_lists(by(rows, 1, 0), 4))


@pytest.mark.parametrize("hot_limit", [3, 1000])
def test_similar_users(spark, hot_limit):
    rows = skewed(3)
    v = by(rows, 0, 1)
    want = {}
    for x in v:
        s = []
        for y in v:
            common = [i for i in v[x] if i in v[y]]
            if x != y and common:
                d = sum(abs(v[x][i] - v[y][i]) for i in common)
                s.append((-len(common), round(d / len(common), 9), y, 1 / (1 + d / len(common))))
        want[x] = [(y, sim) for _, _, y, sim in sorted(s)[:5]]
    close(lists(G.similar_users(frame(spark, rows), 5, hot_limit), "user_id", "similar_user", "similarity"), want)


def test_paths_count_repeat_reviews(spark):
    rows = [(1, 7, 5, 0), (1, 7, 1, 1), (2, 7, 5, 0), (3, 7, 1, 0), (3, 8, 1, 0)]
    df = frame(spark, rows)
    got = lists(G.similar_users_by_paths(df, 5), "user_id", "similar_user", "common_products")
    assert got[2] == [(1, 2), (3, 1)]
    assert lists(G.shared_reviewers(df, 5), "item_id", "similar_item", "shared_reviewers") == {7: [(8, 1)], 8: [(7, 1)]}


@pytest.mark.parametrize("hot_limit", [2, 1000])
def test_shared_reviewers_and_baskets(spark, hot_limit):
    rows = skewed(4)
    v = by(rows, 1, 0)
    want = {x: [(y, n) for n, y in sorted((-len(v[x].keys() & v[y].keys()), y) for y in v if y != x and v[x].keys() & v[y].keys())[:3]] for x in v}
    want = {x: [(y, -n) for y, n in l] for x, l in want.items()}
    df = frame(spark, rows)
    close(lists(G.shared_reviewers(df, 3, hot_limit=hot_limit), "item_id", "similar_item", "shared_reviewers"), want)
    close(lists(G.co_purchases(df, "user_id", "item_id", 3, hot_limit), "item_id", "similar_item", "frequency"), want)


def test_listed_edges(spark):
    p = spark.createDataFrame([(1, [1, 2, 2, 9]), (2, [1]), (3, None)], "item_id long, bought_together array<long>")
    edges = G.listed_edges(p)
    assert sorted(tuple(r) for r in edges.select("src", "dst", "frequency").collect()) == [(1, 2, 2), (2, 1, 1)]
    assert sorted(tuple(r) for r in G.both_directions(edges).collect()) == [(1, 2, 3), (2, 1, 3)]


def user_cf(rows, n, k):
    v = by(rows, 0, 1)
    near = cosine_lists(v, k)
    out = {}
    for u in v:
        total = sum(s for _, s in near[u])
        score = defaultdict(float)
        for y, s in near[u]:
            for i, r in v[y].items():
                if i not in v[u]:
                    score[i] += s * r / total
        out[u] = [(i, -s) for s, i in sorted((-round(s, 9), i) for i, s in score.items())[:n]]
    return out


def test_user_based(spark):
    rows = skewed(5)
    got = lists(R.recommend_user_based(R.rating_matrix(frame(spark, rows)), 4, 6, hot_limit=5), "user_id", "item_id", "score")
    close(got, user_cf(rows, 4, 6))


@pytest.mark.parametrize("hot_limit", [4, 1000])
def test_item_based(spark, hot_limit):
    rows = skewed(6)
    v, w = by(rows, 0, 1), by(rows, 1, 0)
    n = {i: sqrt(sum(r * r for r in d.values())) for i, d in w.items()}
    sim = lambda i, j: sum(r * w[j][u] for u, r in w[i].items() if u in w[j]) / (n[i] * n[j])
    want = {}
    for u in v:
        liked = {j: r for j, r in v[u].items() if r > 3}
        s = [(-round(sum(r * sim(i, j) for j, r in liked.items()) / len(liked), 9), i) for i in w if liked and i not in v[u]]
        want[u] = [(i, -x) for x, i in sorted(s)[:3] if x < 0]
    got = lists(R.recommend_item_based(R.rating_matrix(frame(spark, rows)), 3, hot_limit), "user_id", "item_id", "score")
    close(got, want)


@pytest.mark.parametrize("seed", [0, 1, 2])
@pytest.mark.parametrize("weights", [(1.0,), (1.0, 2.0, 5.0)])
def test_top_scores_with_hot_dims(spark, seed, weights):
    rng = random.Random(seed)
    items = {(i, d): rng.choice(weights) for i in range(60) for d in range(4) if rng.random() < (0.9 if d < 2 else 0.15)}
    queries = {(q, d): rng.choice((1.0, 3.0)) for q in range(12) for d in range(4) if rng.random() < 0.6}
    gone = {(q, i) for q in range(12) for i in range(20) if rng.random() < 0.5}
    want = defaultdict(list)
    for q in range(12):
        s = []
        for i in range(60):
            x = sum(w * items.get((i, d), 0) for (p, d), w in queries.items() if p == q)
            if x > 0 and (q, i) not in gone:
                s.append((-round(x, 9), i))
        if s:
            want[q] = [(i, -x) for x, i in sorted(s)[:5]]
    qs = spark.createDataFrame([(q, d, w) for (q, d), w in queries.items()], "query int, dim int, qw double")
    its = spark.createDataFrame([(i, d, w) for (i, d), w in items.items()], "item int, dim int, iw double")
    ex = spark.createDataFrame(sorted(gone), "query int, item int")
    got = lists(SC.top_scores(qs, its, 5, ex, hot_limit=15, first_depth=4), "query", "item", "score")
    close(got, want)


def test_copies_open_up(spark):
    vectors = [(i, d, 1.0) for i in range(40) for d in ((0, 1) if i % 2 else (0,))]
    members = SC.copy_classes(spark.createDataFrame(vectors, "item long, dim int, iw double"))
    assert {(r["class"], r["item"]): r["place"] for r in members.collect()} == {(i % 2, i): i // 2 for i in range(40)}
    ranked = spark.createDataFrame([(7, 1, 2.0), (7, 0, 1.0)], "query long, class long, score double")
    gone = spark.createDataFrame([(7, 1), (7, 5)], "query long, item long")
    got = lists(SC.expand_classes(ranked, members, 21, gone), "query", "item", "score")[7]
    assert [i for i, _ in got] == [i for i in range(1, 40, 2) if i not in (1, 5)] + [0, 2, 4]


@pytest.mark.parametrize("hot_limit", [2, 1000])
def test_word_sets(spark, hot_limit):
    texts = ["red ring", "red ring", "red plate old", "old plate", "blue ring", "alone", "red ring old plate"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sets = {i: set(t.split()) for i, t in enumerate(texts)}
    want = {}
    for x in sets:
        s = sorted((-round(len(sets[x] & sets[y]) / len(sets[x] | sets[y]), 9), y) for y in sets if y != x and sets[x] & sets[y])
        want[x] = [(y, -v) for v, y in s[:3]]
    close(lists(SIM.similar_by_words(docs, "id", "text", 3, hot_limit), "query_id", "neighbour_id", "similarity"), want)


def test_content_hybrid_and_cold_start(spark):
    rows = [(1, 1, 5, 0), (1, 2, 2, 0), (2, 3, 1, 0), (2, 1, 2, 0)]
    df = frame(spark, rows)
    f = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (3, "a", 1.0), (4, "a", 0.6), (4, "b", 0.8), (5, "a", 1.0)], "item_id long, term string, weight double")
    got = lists(R.recommend_content_based(df, f, 3), "user_id", "item_id", "score")
    assert [i for i, _ in got[1]] == [3, 5, 4] and [s for _, s in got[1]] == pytest.approx([1.0, 1.0, 0.6])
    # User 2 likes nothing, so the best three reviews stand in.
    assert [i for i, _ in got[2]] == [5, 4]
    u = spark.createDataFrame([(1, 3, 4.0, 1)], "user_id long, item_id long, score double, rank int")
    c = R.recommend_content_based(df, f, 3)
    h = lists(R.recommend_hybrid(u, c, 0.5, 3), "user_id", "item_id", "score")
    assert h[1][0] == (3, pytest.approx(2.5)) and [i for i, _ in h[1]] == [3, 5, 4]
    assert lists(R.recommend_hybrid(u, c, 0.5, 3, scale=True), "user_id", "item_id", "score")[1][0] == (3, pytest.approx(1.0))
    users = spark.createDataFrame([(1,), (8,)], "user_id long")
    cold = R.recommend_for_new_users(users, df, u, 2).collect()
    assert {(r["user_id"], r["item_id"], r["source"]) for r in cold} == {(8, 1, "popularity"), (8, 2, "popularity"), (1, 3, "history")}


def test_content_tie_with_rated_head(spark):
    # Items 1 and 9 are equal; item 1 is rated, so the tie with item 2 goes to item 2.
    f = spark.createDataFrame([(1, "a", 1.0), (9, "a", 1.0), (2, "a", 0.6), (2, "b", 0.8), (3, "a", 0.6), (3, "c", 0.8)], "item_id long, term string, weight double")
    df = frame(spark, [(1, 1, 5, 0)])
    got = [(r["item_id"]) for r in R.recommend_content_based(df, f, 2).orderBy("rank").collect()]
    assert got == [9, 2]


def test_model_items_and_report(spark):
    products = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "item_id long, title string")
    ratings = spark.createDataFrame([(1, 4, 5.0), (1, 7, 3.0)], "user_id long, item_id long, rating double")
    kept = {r["item_id"] for r in R.content_model_items(ratings, products, 5).collect()}
    assert {4, 7} <= kept and len(kept) == 5
    assert R.content_model_items(ratings, products).count() == 10
    recs = spark.createDataFrame([(1, 99, 0.12345, 1), (1, 2, 0.1, 2)], "user_id long, item_id long, score double, rank int")
    rep = R.recommendation_report({"m": recs}, products, ratings.select("user_id").distinct()).first()
    assert [(x["title"], x["score"]) for x in rep["recommendations"]] == [("Unknown", 0.123), ("t2", 0.1)]


def test_pairs_stay_in_the_tasks_of_their_entities(spark, monkeypatch):
    from opinara.operators import partners as P

    rows = skewed(5)
    want = lists(G.similar_users(frame(spark, rows), 5), "user_id", "similar_user", "similarity")
    rated = defaultdict(set)
    for u, i, _, _ in rows:
        rated[i].add(u)
    monkeypatch.setattr(P, "PAIRS", 40)
    monkeypatch.setattr(P, "SLICE", 16)
    got = G.similar_users(frame(spark, rows), 5)
    assert got.rdd.getNumPartitions() == -(-sum(len(u) ** 2 for u in rated.values()) // 40)  # more pairs, more parts, not larger ones
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "a_id" in line for line in plan.splitlines())
    assert lists(got, "user_id", "similar_user", "similarity") == want


def test_pairs_with_nulls_and_repeated_rows(spark):
    rows = [(1, 1, 5, 0), (2, 1, None, 0), (3, 1, 2, 0), (1, 2, 1, 0), (3, 2, 4, 0), (None, 1, 5, 0), (2, None, 5, 0), (1, 2, 1, 0)]
    got = {(r["user_id"], r["similar_user"]): (r["common_products"], r["similarity"]) for r in G.similar_users(frame(spark, rows), 5).collect()}
    assert got == {(1, 2): (1, None), (2, 1): (1, None), (1, 3): (2, 0.25), (3, 1): (2, 0.25), (2, 3): (1, None), (3, 2): (1, None)}
    lines = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, 8), (2, 7), (None, 7), (2, None)], "o long, p long")
    assert {tuple(r) for r in G.co_purchases(lines, "o", "p", 3).collect()} == {(7, 8, 2, 1), (8, 7, 2, 1)}


@pytest.mark.parametrize("bits", [10, 1])
def test_paths_in_turns(spark, bits, monkeypatch):
    """Blocks are sent a few at a time, a pair's five counts as one number unless one is too large for that."""
    from opinara.operators import partners as P

    rng = random.Random(11)
    rows = [(rng.randrange(30), rng.randrange(12), rng.randint(1, 5), t) for t in range(300)]
    kinds, task = [], P._joined_sums

    def seen(edges, *args):
        kinds.append(dict(edges.dtypes)["stars"])
        return task(edges, *args)

    written, write = [], P.materialise
    monkeypatch.setattr(P, "_joined_sums", seen)
    monkeypatch.setattr(P, "materialise", lambda df: written.append(1) or write(df))
    monkeypatch.setattr(P, "PAIRS", 500)
    monkeypatch.setattr(P, "TURN", 1)
    monkeypatch.setattr(G, "STAR_BITS", bits)
    paths, gaps = defaultdict(int), defaultdict(int)
    for u, i, r, _ in rows:
        for v, j, s, _ in rows:
            if i == j and u != v:
                paths[u, v] += 1
                gaps[u, v] += abs(r - s)
    got = defaultdict(list)
    for r in G.similar_users_by_paths(frame(spark, rows), 4).orderBy("user_id", "rank").collect():
        got[r["user_id"]].append((r["similar_user"], r["common_products"], r["similarity"]))
    for u in {u for u, *_ in rows}:
        near = sorted((-n, round(gaps[u, v] / n, 9), v) for (a, v), n in paths.items() if a == u)[:4]
        assert got[u] == [(v, -n, pytest.approx(1 / (1 + d), abs=1e-6)) for n, d, v in near]
    assert kinds == ["double" if bits == 10 else "array<double>"]
    assert len(written) > 3  # the rows, the lists and more than one turn
