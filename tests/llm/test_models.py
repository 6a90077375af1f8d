"""Trained operators, the neighbour search and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opinara.llm import ann, langid, lm, ngram_join, quality, queries
from opinara.llm.common import learned


def held(doc_id, modulus, remainder):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus == remainder


# quality


def test_quality_on_held_out_labels(spark, sf):
    out = queries.op1_lsa_neighbours(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    test = [r for r in out if r["held_out"]]
    good, bad = ([r["predicted"] == q for r in test if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) >= 0.9


def test_quality_against_all_cosines(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    m = quality.fit(documents, labels, ~learned("doc_id", 3, 1), rank=16)
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("key")).collect()
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(documents, m, k=5).collect()}
    import pyarrow as pa

    x = np.concatenate(list(quality.features(pa.array([r["text"] for r in rows]), m.buckets)))
    for r, v in zip(rows, x, strict=True):
        v = v * m.rarity
        v = v / max(np.linalg.norm(v), 1e-30) @ m.axes
        near = np.where(m.keys == r["key"], 0, np.maximum(m.vectors @ (v / max(np.linalg.norm(v), 1e-30)), 0))
        top = np.argsort(-near)[:5]
        w = near[top].astype(float) ** 4 * m.weights[top]
        assert got[r["doc_id"]] == pytest.approx((w * m.votes[top]).sum() / w.sum() if w.sum() else m.prior, abs=1e-3)


def test_quality_edges(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (100, 0), (None, 0), (14, 7), (3, None), (1, 1)], "doc_id long, quality int")
    m = quality.fit(edge, labels, F.lit(True))
    assert len(m.keys) == 2
    out = {r["doc_id"]: r["score"] for r in quality.score_quality(edge, m).collect()}
    assert len(out) == len({r["doc_id"] for r in edge.collect()}) and out[5] == out[6] == out[7] == m.prior == 0.5
    assert quality.score_quality(none, m).count() == 0
    nothing = quality.fit(edge, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score_quality(edge, nothing).collect()} == {0.5}
    assert quality.fit(edge, labels, F.lit(True), max_labelled=2).vectors.shape[0] <= 2


# language


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op3_hyperdimensional_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 for r in out)
    long = [r["lang"] == r["lang_pred"] for r in out if r["held_out"] and len(r["text"]) >= 50]
    assert np.mean(long) >= 0.99


def test_profiles_equal_the_sum_of_bound_letters():
    import pyarrow as pa

    texts = ["Ab c, été!", None, "", "123", "中文 x"]
    grams = langid.Trigrams(64)
    got = np.concatenate(list(grams.profiles(pa.array(texts, pa.string()))))
    letter = lambda c: langid.letter_vector(ord(c) if c.isalpha() else 0, 64).astype(int)
    for t, v in zip(texts, got, strict=True):
        s, want = f"\n{(t or '').lower()}\n", np.zeros(64)
        for a, b, c in zip(s, s[1:], s[2:]):
            if b.isalpha():
                want += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
        assert (v == want).all()


def test_large_alphabets_take_the_same_steps(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["".join(chr(0x4E00 + i * 7 % 900) for i in range(400)), "abc abd"])
    one = np.concatenate(list(langid.Trigrams(32).profiles(texts)))
    monkeypatch.setattr(langid, "TABLE", 1 << 40)
    small = pa.array(["abc abd"])
    assert (np.concatenate(list(langid.Trigrams(32).profiles(small))) == one[1]).all()
    monkeypatch.setattr(langid, "TABLE", 1)
    assert (np.concatenate(list(langid.Trigrams(32).profiles(texts))) == one).all()


def test_language_edges(spark, edge, none):
    p = langid.fit(edge, F.lit(True))
    out = langid.identify(edge, p)
    assert out.count() == edge.count() and set(out.columns) == set(edge.columns)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.select("doc_id", "lang_pred", "score").collect()}
    assert found[5] == found[6] == found[7] == found[-5] == ("und", 0.0) and found[1][0] == "en"
    assert {r[0] for r in langid.identify(edge, {}).select("lang_pred").collect()} == {"und"}
    assert langid.identify(none, p).count() == 0 and langid.fit(none, F.lit(True)) == {}


# language model


def test_gradients():
    rng = np.random.default_rng(0)
    net = lm.Network(*(p.astype(np.float64) for p in lm.new_network(np.zeros(lm.CLASSES, np.float32))))
    context, target = rng.integers(0, 50, (7, 4)), rng.integers(0, 9, 7)

    def loss(n):
        return lm.train(lm.Network(*(p.copy() for p in n)), context, target, [np.ones_like(p) for p in n])

    for which, place in ((1, (3, 2)), (3, (5, int(target[0]))), (4, (int(target[1]),)), (2, (4,)), (0, (int(context[0, 0]), 1))):
        moved = lm.Network(*(p.copy() for p in net))
        # with a huge memory the step is -rate * gradient / sqrt(memory)
        lm.train(moved, context, target, [np.full_like(p, 1e12) for p in net])
        gradient = (net[which][place] - moved[which][place]) / lm.RATE * 1e6
        up, down = (lm.Network(*(p.copy() for p in net)) for _ in range(2))
        up[which][place] += 1e-5
        down[which][place] -= 1e-5
        assert gradient == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-6)


def test_probabilities_sum_to_one():
    counts = np.random.default_rng(1).integers(0, 9, 1 << lm.BUCKET_BITS)
    v = lm.build_vocabulary(counts)
    assert np.bincount(v.classes, np.exp(v.within), lm.CLASSES) == pytest.approx(np.ones(lm.CLASSES), abs=1e-3)
    net, offsets = lm.new_network(v.prior), np.array([0, 3])
    one = np.unique(v.classes, return_index=True)[1]  # a bucket of each class
    total = sum(np.exp(lm.log_probabilities(v, net, np.array([5, b, 9]), offsets)[1] - v.within[b]) for b in one)
    assert total == pytest.approx(1, abs=1e-3)


def test_language_model(spark, edge, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lm.fit(docs.repartition(2))
    out = lm.score(docs, model).collect()
    fresh = (model[0], lm.new_network(model[0].prior))
    start = lm.score(docs, fresh).agg(F.sum("log_prob")).first()[0]
    assert sum(r["log_prob"] for r in out) > start and all(r["n_words"] == len(t["text"].encode().split()) for r, t in zip(sorted(out), sorted(docs.collect()), strict=True))
    rng, mixed = random.Random(2), []
    for r in docs.limit(300).collect():
        w = r["text"].split(" ")
        rng.shuffle(w)
        mixed.append((r["doc_id"], " ".join(w)))
    shuffled = lm.score(spark.createDataFrame(mixed, "doc_id long, text string"), model).agg(F.sum("log_prob") / F.sum("n_words")).first()[0]
    real = lm.score(docs.limit(300), model).agg(F.sum("log_prob") / F.sum("n_words")).first()[0]
    assert real > shuffled
    edges = lm.score(edge, model).collect()
    assert len(edges) == edge.count() and all((r["n_words"] == 0) == (r["mean_log_prob"] is None) and (r["n_words"] or r["log_prob"] == 0) for r in edges)
    assert lm.score(none, lm.fit(none)).count() == 0


def test_words_have_their_own_counts(spark):
    """More distinct words than a fixed number of buckets could tell apart."""
    import pyarrow as pa

    rows = [(i, " ".join(f"w{i * 500 + j}" for j in range(500)) + " often" * 3) for i in range(400)]
    v, _ = lm.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rounds=0)
    assert len(v.within) == 400 * 500 + 2  # "often" and unseen words
    h = next(lm.Tokenizer(lm.space_table()).slices(pa.array(["w1 w199999 often never-seen"]))).hashes
    number = lm.numbers_of(v, h)
    assert len(set(number.tolist())) == 4 and number[3] == len(v.within) - 1
    total = np.exp(v.prior[v.classes[number]].astype(float) + v.within[number])
    assert total[:3] / total[3] == pytest.approx([2, 2, 1201], rel=0.05)


def test_every_place_is_hidden_somewhere():
    hashes = np.random.default_rng(4).integers(0, 1 << 63, 6 * 300, dtype=np.uint64)
    offsets = np.arange(0, len(hashes) + 1, 6)
    for r in range(2):
        assert set(lm.hidden_places(hashes, offsets, r, 8) % 6) == set(range(6))


# neighbours


def brute(rows, k):
    out = {}
    ok = [(i, np.array(v, np.float64)) for i, v in dict.fromkeys((i, tuple(v) if v is not None else None) for i, v in rows)
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 3]
    for q, a in ok:
        if q % 2 == 0:
            near = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in ok if i != q)[:k]
            out |= {(q, r + 1): (i, d) for r, (d, i) in enumerate(near)}
    return out


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, 2.0, 0.5]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]),
            (10, [1.0, None, 1.0]), (12, [1.0]), (None, [1.0, 1.0, 1.0]), (13, [1e6, 1.0, -3.0])] + [(20 + i, [5.0, 5.0, 5.0]) for i in range(15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1)).withColumn("label", F.lit("x"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(df, lambda x: x % 2 == 0, k=4, recall=1.0).collect()}
    want = brute(rows, 4)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert [got[k][1] for k in want] == pytest.approx([v[1] for v in want.values()])
    assert ann.search(df.limit(0), lambda x: x % 2 == 0).count() == 0


def test_neighbour_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK_ROWS", 150)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 3)
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asked = lambda x: x % 20 == 0
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in ann.search(vectors, asked, k=10, recall=0.97).collect()}
    want = {(r["query_id"], r["vec_id"]): r["score"] for r in ann.exact(vectors, asked, k=10).collect()}
    both = set(got) & set(want)
    assert len(both) >= 0.9 * len(want) == 225 and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in both)


def test_neighbours_in_clusters_need_few_candidates(spark):
    """Where vectors have structure, a forest finds neighbours among a small share of all rows."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((100, 16)) * 5
    x = centres[np.arange(3000) % 100] + rng.standard_normal((3000, 16)) * 0.3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    sets, _ = ann.distinct_vectors(df, "vec_id", "embedding", 11)
    assert ann.fit_forest(sets, 10, 0.95).candidates <= 3000
    got = {(r["query_id"], r["vec_id"]) for r in ann.search(df, lambda i: i % 100 == 0).collect()}
    want = {(r["query_id"], r["vec_id"]) for r in ann.exact(df, lambda i: i % 100 == 0).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_neighbours_closer_than_the_codes(spark):
    """Near copies whose distances are below the rounding of the codes, beside spread rows."""
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(24)
    x = np.concatenate([centre / np.linalg.norm(centre) + rng.standard_normal((400, 24)) * 1e-5, rng.standard_normal((4000, 24))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got, want = ({(r["query_id"], r["vec_id"]) for r in f(df, lambda i: (i < 400) & (i % 20 == 0), k=10).collect()} for f in (ann.search, ann.exact))
    assert len(want) == 200 and len(got & want) >= 0.9 * len(want)


def test_neighbours_in_thin_regions(spark):
    """Rows alone in their parts of all trees get their k neighbours like others."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((8, 16)) * 10
    x = np.concatenate([centres[np.arange(1600) % 8] + rng.standard_normal((1600, 16)) * 0.01, rng.standard_normal((20, 16)) * 10])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    sets, _ = ann.distinct_vectors(df, "vec_id", "embedding", 11)
    assert ann.fit_forest(sets, 10, 0.95).depth > 0
    got, want = ({(r["query_id"], r["vec_id"]) for r in f(df, lambda i: i >= 1590, k=10).collect()} for f in (ann.search, ann.exact))
    assert len(got) == len(want) == 300
    assert len(got & want) >= 0.5 * len(want)


# pipeline


def test_pipeline(spark, sf):
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialise(stage(spark, docs, sf))
        sizes[name] = docs.count()
        if name != "shard":
            assert docs.columns == first.columns
        if name == "near_duplicates":
            assert docs.count() == before.count() - sum(1 for r in ngram_join.near_duplicates(before).collect() if r["doc_id"] != r["class_id"])
            assert ngram_join.near_duplicates(docs).filter("n_links > 0").count() == 0
        if name == "decontaminate":
            bench = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in docs.collect()}
            assert gone == {r["doc_id"] for r in before.collect() if any(b in r["text"] for b in bench)}
    run = corpus_pipeline.run(spark, sf)
    assert run.count() == sizes["shard"] == sizes["mix"] and sizes["language"] <= first.count()
    assert sorted(map(str, run.collect())) == sorted(map(str, docs.collect()))


def test_pipeline_stages_on_edges(spark, edge, none, sf):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0
        assert set(edge.columns) <= set(stage(spark, edge, sf).columns)
