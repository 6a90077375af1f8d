"""Operators with a definition that a few lines of Python can repeat on small tables."""

import bisect
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.llm import decontaminate, mixing, ngram_join, sharding, substrings, warc
from opinara.llm.tokens import Tokenizer, space_table, window_hashes, windows_inside


def words(text):
    return (text or "").encode().split()


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def lowest(doc_id):
    return -(1 << 63) if doc_id is None else doc_id


def same_rows(got, expected):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_words_and_windows():
    texts = ["a bb  a\tbb", None, "", "é x y", "a" * 5000 + " b"]
    for size in (1, 7, 1 << 20):
        tokens, found = Tokenizer(space_table(), size), []
        for w in tokens.slices(pa.array(texts)):
            for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True):
                found.append([bytes(w.data[i:j]) for i, j in zip(w.starts[a:b], w.ends[a:b], strict=True)])
        assert found == [words(t) for t in texts]
    (w,) = Tokenizer(space_table()).slices(pa.array(texts))
    assert w.hashes[0] == w.hashes[2] and w.hashes[1] == w.hashes[3] and len(set(w.hashes.tolist())) == 6
    ok = windows_inside(w.offsets, 3, len(w.hashes))
    assert ok.tolist() == [True, True, False, False, False, False, False, False]
    x = np.arange(100, dtype=np.uint64) % np.uint64(7)
    for n in (1, 2, 5, 20):
        h = window_hashes(x, n, 0x9E3779B97F4A7C15)
        groups = defaultdict(set)
        for i, v in enumerate(h.tolist()):
            groups[v].add(tuple(x[i:i + n].tolist()))
        assert len(h) == 101 - n and all(len(g) == 1 for g in groups.values()) and len(groups) == 7


def repeated(rows, n=20):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            first[k] = min(first.get(k, (lowest(d), i)), (lowest(d), i))
    out = []
    for d, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < (lowest(d), i):
                keep[i:i + n] = [False] * n
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out.append((d, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("table", ["documents", "edge", "none"])
def test_repeated_spans(table, request):
    df = request.getfixturevalue(table)
    got = substrings.remove_repeated_spans(df, keep_text=False, blocks=5).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same_rows([tuple(r) for r in got], repeated(pairs(df)))


def test_repeated_spans_of_periodic_and_shared_text(spark):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(25)]
    rows = []
    for d in range(60):
        w = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60))]
        if d % 3 == 0:
            w[len(w) // 2:len(w) // 2] = passage
        if d % 7 == 0:
            w += ["u", "v"] * 12
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = substrings.remove_repeated_spans(df, blocks=7).collect()
    same_rows([tuple(r)[:4] for r in out], repeated(rows))
    text = dict(rows)
    for r in out:
        for s in r["spans"]:  # every span is at its source coordinates too
            assert words(text[r["doc_id"]])[s["start"]:s["start"] + s["words"]] == words(text[s["source_doc"]])[s["source_start"]:s["source_start"] + s["words"]]
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]


def near(rows, n=5):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root, degree = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_gram = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by_gram[g].append(i)
    shared = Counter((a, b) for group in by_gram.values() for k, b in enumerate(group) for a in group[:k])
    for (a, b), c in shared.items():
        if 5 * c >= 4 * len(sets[a] | sets[b]):
            degree[a], degree[b] = degree[a] + 1, degree[b] + 1
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return [(d, least[find(i)], degree[i]) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("table", ["documents", "edge", "none"])
def test_near_duplicates(table, request):
    df = request.getfixturevalue(table)
    got = ngram_join.near_duplicates(df).select("doc_id", "class_id", "n_links").collect()
    same_rows([tuple(r) for r in got], near(pairs(df)))


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    """A third of all rows are near copies with different texts, cut into chunks; none of their links is lost."""
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 7)
    rng, base, rows = random.Random(1), [f"b{i}" for i in range(120)], []
    for d in range(90):
        w = list(base) if d % 3 == 0 else [f"{d}y{i}" for i in range(50)]
        for _ in range(3 if d % 3 == 0 else 0):
            w[rng.randrange(len(w))] = f"n{rng.randrange(1000)}"
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.near_duplicates(df, recall=0.9999999).select("doc_id", "class_id", "n_links").collect()
    same_rows([tuple(r) for r in got], near(rows))


def test_near_duplicates_between_tasks(documents):
    """The same classes whether copies meet in one task or only in the shuffle."""
    apart = documents.repartition(8, "doc_id")
    got = [tuple(r) for r in ngram_join.near_duplicates(apart).select("doc_id", "class_id", "n_links").collect()]
    same_rows(got, near(pairs(documents)))


def test_band_plan():
    bands, rows = ngram_join.band_plan(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995 > 1 - (1 - 0.8 ** rows) ** (bands - 1)


def test_keep_one(edge, none):
    kept = [r["doc_id"] for r in ngram_join.keep_one(edge).collect()]
    assert Counter(kept)[1] == 1 and not {2, 3, 9, 11, 13, 101, 1 << 62} & set(kept)
    assert {4, 5, 6, 7, 8, 10, 12, 14, 15, -5, 100} <= set(kept)
    assert ngram_join.keep_one(edge).columns == edge.columns and ngram_join.keep_one(none).count() == 0


def water_fill(sizes, weights):
    total, full, out = sum(sizes), set(), {}
    while True:
        left, w = total - sum(3 * sizes[i] for i in full), sum(weights[i] for i in range(len(sizes)) if i not in full)
        out = {i: 3 * sizes[i] if i in full else left * weights[i] / w for i in range(len(sizes))}
        over = {i for i in out if out[i] > 3 * sizes[i]}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_mix(table, request):
    df = request.getfixturevalue(table)
    taken, mix = mixing.mix_sources(df, block_words=16)
    got = taken.collect()
    sizes = Counter()
    for r in df.select("source", "text").collect():
        sizes[r["source"]] += len(words(r["text"]))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goal = water_fill([sizes[s] for s in names], [i % 3 + 1 for i in range(len(names))])
    same_rows([(r["doc_id"], r["source"], r["size"]) for r in got], [(r["doc_id"], r["source"], len(words(r["text"]))) for r in df.select("doc_id", "source", "text").collect()])
    by_source = Counter()
    for r in got:
        i = names.index(r["source"])
        by_source[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[i]) and r["taken"] <= 3 * r["size"]
    for i, s in enumerate(names):
        assert abs(by_source[s] - goal[i]) <= 0.5
    assert [tuple(r) for r in sorted(got, key=str)] == [tuple(r) for r in sorted(mixing.mix_sources(df, block_words=16)[0].collect(), key=str)]
    slots = defaultdict(int)
    for r in mix.collect():
        slots[r["slot"]] += r["words"]
        assert r["words"] > 0
    assert sum(slots.values()) == sum(by_source.values()) and max(slots.values()) <= 16


def test_schedule_is_even(spark):
    """Every stretch of the mix is close to the targets."""
    plan = spark.createDataFrame([(0, 1600, 100), (1, 4800, 300), (2, 9590, 600), (3, 0, 0)], "sid long, goal long, blocks long")
    rows = sorted(tuple(r) for r in mixing.schedule(plan, 16).collect())
    assert Counter(r[1] for r in rows) == {0: 100, 1: 300, 2: 600} and sum(r[3] for r in rows) == 15990
    assert len({r[0] for r in rows}) == 1000
    for sid, share in ((0, 0.1), (1, 0.3), (2, 0.6)):
        mine = sorted((r[2], r[0]) for r in rows if r[1] == sid)
        assert [m[0] for m in mine] == list(range(len(mine)))
        for n in (50, 200, 600):
            assert abs(sum(r[0] < n for r in rows if r[1] == sid) - share * n) <= 4


def test_mix_of_nothing(none):
    taken, mix = mixing.mix_sources(none)
    assert taken.count() == 0 and mix.count() == 0


@pytest.mark.parametrize("table", ["documents", "edge"])
@pytest.mark.parametrize("part_rows", [1_000_000, 3])
def test_shards(table, part_rows, request):
    df = request.getfixturevalue(table)
    rows = sharding.shard_by_bytes(df, 7, part_rows=part_rows).select("doc_id", "text", "size", "shard", "slot").collect()
    expected = [(d, t, len((t or "").encode()) + 16) for d, t in pairs(df)]
    same_rows([tuple(r)[:3] for r in rows], expected)
    total, before = sum(e[2] for e in expected), 0
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    keys = [(hashlib.md5((r["text"] or "").encode()).hexdigest()[:16], lowest(r["doc_id"])) for r in order]
    assert keys == sorted(keys)
    for r in order:
        assert r["shard"] == before * 7 // total
        before += r["size"]
    for s in range(7):
        assert [r["slot"] for r in order if r["shard"] == s] == list(range(sum(r["shard"] == s for r in order)))


def test_shards_with_tolerance_and_of_nothing(documents, none):
    rows = sharding.shard_by_bytes(documents, 4, tolerance=0.05).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(rows) == 4 and max(r["s"] for r in rows) / (sum(r["s"] for r in rows) / 4) < 1.1
    assert sharding.shard_by_bytes(none, 4).count() == 0


def test_thousands_of_boundaries(spark):
    rng = np.random.default_rng(4)
    names, sizes = rng.bytes(24 * 3000), rng.integers(1, 5000, 3000)
    keys = sorted({names[24 * i:24 * i + 24] for i in range(3000)})
    df = spark.createDataFrame([(bytearray(k), int(s)) for k, s in zip(keys, sizes)], "key binary, size long").repartition(4)
    before = np.concatenate([[0], np.cumsum(sizes)])
    parts, total = 4000, int(before[-1])
    for every in (1, 100):
        cuts = sharding.splitters(df, parts, every=every)
        assert [c.key for c in cuts] == sorted(c.key for c in cuts)
        for i, c in enumerate(cuts, 1):
            first = int(np.searchsorted(before * parts, i * total))
            at = bisect.bisect_left(keys, c.key)
            assert (c.size, c.rows) == (before[at], at)
            assert at == first if i % every == 0 else at >= first


def test_crc_is_unsigned(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    assert {r[0]: r[1] for r in df.select("text", F.crc32(F.col("text").cast("binary"))).collect()} == {f"t{i}": zlib.crc32(f"t{i}".encode()) for i in range(50)}


def edit_least(item, doc):
    """Fewest edits from `item` to any run of `doc` that starts at a word of it."""
    best = len(item) + 1
    for p in range(len(doc)):
        row = list(range(min(len(doc) - p, 2 * len(item)) + 1))
        for i, w in enumerate(item):
            new = [i + 1]
            for j in range(1, len(row)):
                new.append(min(row[j - 1] + (doc[p + j - 1] != w), row[j] + 1, new[-1] + 1))
            row = new
        best = min(best, *row)
    return best


def plain_words(text):
    import re

    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(25)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 14)))) for i in range(8)] + [(20, None), (21, ""), (None, "v1 v2 v3"), (22, "...")]
    docs = []
    for d in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 40))]
        if d % 2:
            i = rng.choice(items[:8])[1].split()
            for _ in range(rng.randrange(0, 3)):
                k = rng.randrange(len(i))
                i[k:k + 1] = rng.choice([[], ["zz"], [i[k], "yy"]])
            w[len(w) // 2:len(w) // 2] = i
        docs.append((d, ", ".join(w).upper()))
    docs += [(100, None), (101, ""), (102, "?!"), (None, items[0][1])]
    df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.find_leaks(df.repartition(3), items_df, tables=64).collect()
    expected = {}
    for d, t in docs:
        for i, s in items:
            item = plain_words(s)
            if i is not None and item:
                e = edit_least(item, plain_words(t))
                if e <= len(item) * 0.2 + 1e-9:
                    expected[d, i] = e
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found}
    assert len(got) == len(found) and set(got) <= set(expected) and all(got[k] == expected[k] for k in got)
    assert {k for k, e in expected.items() if e == 0} <= set(got) and len(got) >= 0.97 * len(expected)
    kept = {r["doc_id"] for r in decontaminate.drop_leaking(df, items_df).collect()}
    assert not kept & {d for d, _ in got} and {100, 101, 102} <= kept


def test_leaks_edges(edge, none, benchmark_items):
    assert decontaminate.find_leaks(edge, benchmark_items).count() == 0
    assert decontaminate.find_leaks(none, benchmark_items).count() == 0
    assert decontaminate.find_leaks(edge, benchmark_items.limit(0)).count() == 0
    assert decontaminate.drop_leaking(edge, benchmark_items).count() == edge.count()


def test_leaks_in_several_passes(documents, benchmark_items, monkeypatch):
    one = decontaminate.find_leaks(documents, benchmark_items).collect()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 1000)
    many = decontaminate.find_leaks(documents, benchmark_items).collect()
    assert one and {(r["doc_id"], r["item_id"]) for r in one} == {(r["doc_id"], r["item_id"]) for r in many}


def pages(spark):
    big, other = "<p>é" * 300, "<b>" * 400
    rows = [(1, "http://a/1 x\r\ny", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", big), (None, "u", other), (8, "u", "x" * 1000), (9, "u", "x" * 1000), (10, "u", "y" * 999), (11, "u", "y" * 999)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3), rows


def test_warc_round_trip(spark, tmp_path):
    df, rows = pages(spark)
    warc.write_archives(df, str(tmp_path / "w"), frame_bytes=2000, bundle_bytes=300)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    keep = defaultdict(lambda: None)
    for p, _, h in rows:
        h = (h or "").encode()
        if p is not None and len(h) >= 1000:
            keep[h] = max(p, keep[h] or p)
    expected = []
    for p, _, h in rows:
        h = (h or "").encode()
        refers = keep[h] if keep[h] is not None and (p is None or p < keep[h]) else None
        expected.append((p, len(h), hashlib.sha1(h).hexdigest(), "response" if refers is None else "revisit", refers, h if refers is None else None))
    same_rows([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got], expected)
    assert {r["refers_to_record"] for r in got if r["refers_to"] is not None} <= {r["record_id"] for r in got if r["record_type"] == "response"}


def test_warc_random_access_and_format(spark, tmp_path):
    import zstandard

    df, rows = pages(spark)
    path = str(tmp_path / "w")
    warc.write_archives(df, path, frame_bytes=500)
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-") and f.stat().st_size]
    assert files
    for f in files:  # any Zstandard reader gets all records
        data = zstandard.ZstdDecompressor().stream_reader(f.read_bytes(), read_across_frames=True).read()
        assert data.startswith(b"WARC/1.1\r\n")
        assert len(warc.seek_table(f.read_bytes())) >= 2
    wanted = spark.createDataFrame([(warc.record_id(8, hashlib.sha1(b"x" * 1000).hexdigest()),), (warc.record_id(4, hashlib.sha1(b"short").hexdigest()),), ("urn:none",)], "record_id string")
    got = {r["page_id"]: r for r in warc.fetch_records(spark, path, wanted).collect()}
    assert set(got) == {4, 8} and bytes(got[4]["payload"]) == b"short" and got[8]["record_type"] == "revisit"


def test_warc_of_nothing(spark, tmp_path):
    df, _ = pages(spark)
    warc.write_archives(df.limit(0), str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


def test_warc_notices_damage(spark):
    record = warc.encode_record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), False, None, "1970-01-01T00:00:00Z")
    assert warc.decode_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.decode_record(record.replace(b"payload\r\n", b"pAyload\r\n"))


@pytest.mark.parametrize("words", [1, 7, 40, 100, 200])
@pytest.mark.parametrize("where", ["first half", "second half", "anywhere", "both ends"])
def test_leaks_of_any_length_wherever_the_edits_lie(words, where):
    rng = np.random.default_rng(words)
    text = lambda n: [f"v{i}" for i in rng.integers(0, 5000, n)]
    items, docs, limit = [text(words) for _ in range(30)], [], int(words * 0.2 + 1e-9)
    for item in items:
        half, end = max(words // 2, limit), limit // 2
        places = {"first half": range(half), "second half": range(words - half, words), "anywhere": range(words), "both ends": [*range(end), *range(words - limit + end, words)]}[where]
        w = list(item)
        for p in sorted(rng.choice(places, limit, replace=False), reverse=True):
            w[p:p + 1] = [[], [f"new{p}"], [f"new{p}", w[p]]][rng.integers(3)]
        docs.append(text(rng.integers(0, 50)) + w + text(rng.integers(0, 50)))
    index = decontaminate.index_items(list(range(30)), [" ".join(i) for i in items])
    hashes = decontaminate.word_hashes([" ".join(d) for d in docs])
    found = decontaminate.matches(np.concatenate(hashes), np.cumsum([0, *map(len, hashes)]), index)
    assert {i for i in range(30)} <= {row for row, item, *_ in found if index.ids[item] == row}
    for row, item, edits, start, length in found[:10]:
        assert edits == edit_least(items[item], docs[row]) == edit_least(items[item], docs[row][start:start + length]) <= limit


def test_items_without_id_are_searched(spark):
    docs = spark.createDataFrame([(1, "a b one two three four c"), (2, "nothing of it"), (3, "five six seven eight")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "one two three four"), (None, None), (7, "five six seven eight")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()) == [(1, None), (3, 7)]
    assert [r["doc_id"] for r in decontaminate.drop_leaking(docs, items).collect()] == [2]
