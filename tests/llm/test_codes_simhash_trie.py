"""Vector codes, SimHash and the conversation trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from opinara.llm import prefix_trie, simhash, vector_codes


def words(text):
    return (text or "").encode().split()


# vector codes


def plain_codes(rows, parts=4, size=256, rounds=4, scale=1024):
    """Every round scans every entry."""
    kept = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in kept], np.float64) * scale).astype(np.int64)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % parts))).reshape(len(x), parts, -1)
    books = x[:size].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        at = d.argmin(axis=2)
        if step < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    mine = x[at[:, p] == e, p]
                    if len(mine):
                        books[p, e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    error = d.min(axis=2).sum(axis=1)
    by_label = defaultdict(int)
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] += int(e)
    return [(r[0], "".join(f"{c:02x}" for c in a), int(e), by_label[r[2]]) for r, a, e in zip(kept, at, error, strict=True)], books


def code_rows(df):
    return [tuple(r) for r in df.select("vec_id", "code", "error", "label_error").collect()]


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_codes_of_the_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got, books = vector_codes.compress(df)
    want, plain = plain_codes([(r["vec_id"], list(r["embedding"]), r["label"]) for r in df.collect()])
    assert sort(code_rows(got)) == sort(want) and (books == plain).all()
    assert vector_codes.fingerprint(books) == hashlib.sha256(",".join(str(v) for p in plain for e in p for v in e).encode()).hexdigest()


@pytest.mark.parametrize("grid, dims", [(3, 8), (2, 4), (1000, 6)])
def test_codes_with_ties_and_odd_rows(spark, grid, dims):
    """Coordinates from a coarse grid give equal distances, equal entries and entries that stay; lengths that are no multiple of four."""
    rng = random.Random(grid)
    rows = [(i, [rng.randrange(grid) / 8 - 0.1 for _ in range(dims)], rng.choice([None, 1, 2])) for i in range(400)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (None, rows[3][1], None), (-3, rows[4][1], 2)]
    odd = [(900, None, 1), (901, [], 1), (902, [1.0] * (dims - 1) + [None], 1), (903, [float("nan")] * dims, 2), (904, [float("inf")] * dims, 2), (905, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(c) for c in ("id", "codes", "n", "total", "sums")}).repartition(5)
    got, books = vector_codes.compress(df, size=16)
    want, plain = plain_codes(rows, size=16)
    assert sort(code_rows(got)) == sort(want) and (books == plain).all()


def test_codes_of_few_large_and_no_rows(spark):
    rows = [(i, [float(1 << 22) * ((i * j) % 5 - 2) for j in range(4)], None) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got, books = vector_codes.compress(df)
    want, plain = plain_codes(rows)
    assert sort(code_rows(got)) == sort(want) and books.shape == (4, 6, 1) and (books == plain).all()
    none, books = vector_codes.compress(df.filter("vec_id < 0"))
    assert none.count() == 0 and books.size == 0 and none.columns == got.columns


def test_only_moved_entries_are_compared():
    """A part whose entry stayed is never compared with another entry that stayed."""
    rng = np.random.default_rng(4)
    x, entries = rng.integers(-50, 50, (300, 3)), rng.integers(-50, 50, (20, 3))
    at, d = vector_codes.nearest(x, entries)
    moved = np.zeros(20, bool)
    moved[[2, 9]] = True
    new = entries.copy()
    new[2], new[9] = x[0], entries[3]  # 9 now ties with 3
    got = vector_codes.advance(x, new, moved, at, d)
    want = vector_codes.nearest(x, new)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    seen, plain = [], vector_codes.nearest
    try:
        vector_codes.nearest = lambda a, e: seen.append((len(a), len(e))) or plain(a, e)
        vector_codes.advance(x, new, moved, at, d)
    finally:
        vector_codes.nearest = plain
    stale = int(moved[at].sum())
    assert seen == [(stale, 20), (300 - stale, 2)]


# SimHash


def plain_print(text, n=4):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in words(text)]
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def plain_components(prints, radius=4):
    fps = sorted(set(prints))
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                up[find(a)] = find(b)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("table", ["documents", "edge", "none"])
def test_simhash_of_tables(table, request):
    df = request.getfixturevalue(table)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    prints = [plain_print(t) for _, t in rows]
    root = plain_components(prints)
    least = {}
    for (d, _), f in zip(rows, prints, strict=True):
        if d is not None:
            least[root[f]] = min(least.get(root[f], d), d)
    want = [(d, f"{f:016x}", least.get(root[f])) for (d, _), f in zip(rows, prints, strict=True)]
    got = [tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()]
    assert sort(got) == sort(want)


def test_balls_reach_every_pair():
    """All ways to spread up to r flipped bits over the segments hit some ball."""
    rng = random.Random(8)
    for radius in (0, 1, 3, 4, 7):
        for m in (2, 3, 4, 5, 8):
            cut = simhash.segments(m, radius)
            assert sum(width for _, width, _ in cut) == 64
            if sum(len(masks) for _, _, masks in cut) > 50_000:
                continue
            balls = [(shift, (1 << width) - 1, set(masks.tolist())) for shift, width, masks in cut]
            for _ in range(300):
                flips = sum(1 << b for b in rng.sample(range(64), radius))
                assert any(flips >> shift & low in ball for shift, low, ball in balls)


@pytest.mark.parametrize("chunk", [4, 50, 4096])
def test_links_of_hot_values(spark, chunk):
    """A cluster around one fingerprint, a chain of steps, and strangers; small chunks make most values hot."""
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(250)} | {rng.getrandbits(64) for _ in range(250)}
    at = rng.getrandbits(64)
    for _ in range(40):
        prints.add(at)
        at ^= sum(1 << b for b in rng.sample(range(64), 4))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_pairs(nodes, 4, chunk).collect()]
    root = plain_components(prints)
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        assert root[a] == root[b]
        up[find(a)] = find(b)
    assert len({find(p) for p in prints}) == len(set(root.values()))


def test_a_cluster_sends_no_pairs():
    """What a task hands on is a forest: fewer links than nodes."""
    rng = np.random.default_rng(3)
    fps = np.unique(np.uint64(1 << 40) ^ (np.uint64(1) << rng.integers(0, 12, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 12, 3000).astype(np.uint64)))
    keys = np.zeros(len(fps), np.uint64)
    a, b = simhash.links(keys, fps, keys, fps, 4)
    assert len(a) == len(fps) - 1 and len(set(b.tolist())) == 1


# conversations


def plain_turns(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    return [(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children.get(n, 0), leaves[n], saved[n],
             hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items()]


CONVERSATION = "conv_id long, turn long, role string, text string"


def trie_rows(df):
    return [tuple(r) for r in df.select(*prefix_trie.COLUMNS).collect()]


@pytest.mark.parametrize("shard_turns, nodes", [(200_000, 200_000), (3, 200_000), (3, 20), (3, 0)])
def test_trie_of_the_table(spark, sf, shard_turns, nodes):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    turns = prefix_trie.with_shared_openings(prefix_trie.ordered_turns(df))
    want = plain_trie(rebuilt(plain_turns([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])))
    assert sort(trie_rows(prefix_trie.build_trie(turns, shard_turns, nodes))) == sort(want)


def odd_conversations():
    rng = random.Random(5)
    rows = [(1, 0, "user", "é\U0001f600x"), (1, None, None, "first"), (1, 1, None, None), (2, 0, "user", "ab"), (2, 0, "user", "ab"), (None, 0, "user", "lost"), (None, None, None, None),
            (105, 0, "user", "a"), (-7, 0, "u", "neg"), (100_000_000_005, 3, "user", "large"), (3, 0, "", ""), (4, 0, "a", "bc"), (5, 0, "ab", "c")]
    for c in range(200, 560):  # a hot opening, a hot conversation, a long one
        rows += [(c, 0, "user", "hello")]
        if c % 3:
            rows += [(c, t, "assistant", "same") for t in range(1, 4)]
        else:
            rows += [(c, t, "user", rng.choice("abc")) for t in range(1, rng.randrange(2, 7))]
    return rows + [(300, t, "user", f"t{t}") for t in range(10, 500)] + [(200, t, "user", "opening") for t in range(9)]


@pytest.mark.parametrize("pending", [2, 50_000])
def test_trie_of_odd_conversations(spark, pending, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PENDING", pending)
    rows = odd_conversations()
    df = spark.createDataFrame(rows, CONVERSATION).withColumns({c: F.lit(c) for c in ("depth", "name", "parent", "key", "turns", "base")}).repartition(4)
    turns = prefix_trie.ordered_turns(df)
    for paths, plain in ((turns, plain_turns(rows)), (prefix_trie.with_shared_openings(turns), rebuilt(plain_turns(rows)))):
        for shard_turns in (5, 200_000):
            assert sort(trie_rows(prefix_trie.build_trie(paths, shard_turns, 500))) == sort(plain_trie(plain))


def test_trie_without_conversations(spark):
    none = spark.createDataFrame([], CONVERSATION)
    assert prefix_trie.build_trie(prefix_trie.with_shared_openings(prefix_trie.ordered_turns(none))).count() == 0


def test_skeleton_splits_a_hot_prefix(spark):
    """A prefix that most paths share is cut, and no splitter is longer than it takes to tell its neighbours apart."""
    key = lambda i: f"{i:048x}"
    rows = [(c, [key(1), key(2), key(3 + c % 7), key(c), key(5)]) for c in range(4000)]
    paths = spark.createDataFrame(rows, "conv_id long, turns array<string>").select(F.unhex(F.array_join("turns", "")).alias("path"))
    cuts = prefix_trie.choose_splitters(paths, 40)
    assert 30 <= len(cuts) <= 39 and all(len(c) <= 4 * prefix_trie.TURN for c in cuts)
    assert len(prefix_trie.choose_splitters(paths, 40, 60)) < 20


# faults of earlier operators


def test_rows_without_id_stay_linear(spark, monkeypatch):
    """Different texts without doc_id, and copies of one, send each set's text to verification once for each chunk pair."""
    from opinara.llm import ngram_join

    story = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join([*story, f"tail{i}"])) for i in range(40)] + [(None, " ".join(story))] * 30
    sent = []
    plain = ngram_join._verify
    counted = spark.sparkContext.accumulator(0)

    def verify(*args):
        inner = plain(*args)

        def run(table):
            counted.add(table.num_rows)
            return inner(table)

        return run

    monkeypatch.setattr(ngram_join, "_verify", verify)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_join.near_duplicates(df).collect()
    sent.append(counted.value)
    assert len(got) == 70 and {r["n_links"] for r in got} == {69} and {r["class_id"] for r in got} == {None}
    assert sent[0] == 41


def test_equal_texts_with_different_labels(spark):
    from opinara.llm import quality

    docs = spark.createDataFrame([(1, "same words here"), (2, "same words here"), (3, "other text entirely"), (4, "same words here now")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels, learn=F.lit(True))
    assert sorted(model.votes.tolist()) == [0.0, 0.5]
