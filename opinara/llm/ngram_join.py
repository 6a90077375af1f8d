"""Near-duplicate documents by Jaccard similarity of word n-grams.

1. Each text gives its set of n-gram hashes, and from it a 128-bit set key, MinHash values in
   `bands` bands of `rows`, and its size. Documents with equal sets are one class from here on.
2. Band hashes are shuffled and sets that agree in a band become candidates. A task sends one
   set for each band hash it holds and links its other sets to that one, so a band that a
   third of all sets share costs one row for each task.
3. Candidates that hang together are brought together with their texts once, cut into chunks of
   bounded size; every pair that shares a band is verified on the full n-gram sets. Only
   each set's number of links and a spanning forest of the links leave a task.
4. Classes are the components of the verified links.

With similarity s a pair is found with probability 1 - (1 - s^rows)^bands.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import fresh
from opinara.llm.tokens import Tokenizer, mix, space_table, window_hashes, windows_inside
from opinara.operators.dbscan import connected_components
from opinara.session import materialise

BASE = 0xD6E8FEB86659FD93
CHUNK_GRAMS, CHUNK_SETS = 2_000_000, 1500
FLUSH_SETS = 50_000  # sets whose band hashes a task holds at once
NO_ID = -(1 << 63)


def band_plan(threshold: float, recall: float, rows: int = 6) -> tuple[int, int]:
    """(bands, rows): the fewest bands of `rows` that find a pair at `threshold` with probability `recall`."""
    return int(np.ceil(np.log1p(-recall) / np.log1p(-(threshold ** rows)))), rows


def gram_sets(column, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a text of fewer than n words is one gram, one without words none."""
    tokens = Tokenizer(space_table())
    for w in tokens.slices(column):
        grams = window_hashes(w.hashes, n, BASE)
        ok = windows_inside(w.offsets, n, len(w.hashes))[:len(grams)]
        for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(grams[a:b - n + 1])
            elif b > a:
                yield mix(np.array([window_hashes(w.hashes[a:b], b - a, BASE)[0] + np.uint64(b - a)], np.uint64))
            else:
                yield np.empty(0, np.uint64)
        del ok


def set_key(grams: np.ndarray) -> bytes:
    """128 bits that depend on the whole set."""
    a, b = np.sum(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64), np.sum(mix(grams + np.uint64(0x14057B7EF767814F)), dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = (rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint64) | 1).astype(np.uint32)
        self.b = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint64).astype(np.uint32)

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        x = (grams >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(x), 512):  # a block stays in the cache
            low = np.minimum(low, (self.a * x[None, i:i + 512] + self.b).min(axis=1))
        low = low.reshape(self.bands, self.rows).astype(np.uint64)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for i in range(self.rows):
            out = mix(out * np.uint64(BASE) + low[:, i])
        return out


def _sketch(n: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = MinHash(bands, rows)
        for batch in batches:
            keys, sizes, hashes = [], [], []
            for grams in gram_sets(batch.column(1), n):
                keys.append(set_key(grams) if len(grams) else None)
                sizes.append(len(grams))
                hashes.append(family.band_hashes(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary())],
                                             names=["doc_id", "text_key", "k", "n", "bands"])

    return sketch


def _band_messages(buckets: int):
    """Links inside the task (bucket null), and one set for each band hash."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(keys: list[bytes], hashes: list[bytes]) -> pa.RecordBatch:
            sets = np.array(keys, "V16")
            band = np.frombuffer(b"".join(hashes), np.uint64)
            owner = np.repeat(np.arange(len(keys)), len(band) // len(keys))
            order = np.argsort(band, kind="stable")
            band, owner = band[order], owner[order]
            head = np.concatenate([[True], band[1:] != band[:-1]])
            hub = owner[head][np.cumsum(head) - 1]
            linked = np.unique(np.stack([hub, owner], 1)[hub != owner], axis=0)
            rows = [(None, None, sets[linked[:, 0]].tobytes(), sets[linked[:, 1]].tobytes())] if len(linked) else []
            band, owner = band[head], owner[head]
            cuts = np.searchsorted(((band >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)), np.arange(buckets + 1).astype(np.uint64))
            rows += [(k, band[i:j].tobytes(), sets[owner[i:j]].tobytes(), None) for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if i < j]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "band", "a", "b"])

        keys, hashes = [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            hashes += batch.column(1).to_pylist()
            if len(keys) >= FLUSH_SETS:
                yield flush(keys, hashes)
                keys, hashes = [], []
        if keys:
            yield flush(keys, hashes)

    return send


def _meet(table: pa.Table) -> pa.Table:
    """Links the sets that share a band hash to the first of them."""
    band = np.concatenate([np.frombuffer(x, np.uint64) for x in table["band"].to_pylist()])
    sets = np.concatenate([np.frombuffer(x, "V16") for x in table["a"].to_pylist()])
    order = np.argsort(band, kind="stable")
    band, sets = band[order], sets[order]
    head = np.concatenate([[True], band[1:] != band[:-1]])
    hub = sets[head][np.cumsum(head) - 1]
    keep = hub.tobytes(), sets.tobytes()
    pairs = np.unique(np.stack([np.frombuffer(x, np.uint64).reshape(-1, 2) for x in keep], 1)[~head].reshape(-1, 4), axis=0) if not head.all() else np.empty((0, 4), np.uint64)
    a, b = np.ascontiguousarray(pairs[:, :2]), np.ascontiguousarray(pairs[:, 2:])
    return pa.table({"a": pa.array([x.tobytes() for x in a], pa.binary()), "b": pa.array([x.tobytes() for x in b], pa.binary())})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cut = lambda x: [x[i:i + 16] for i in range(0, len(x), 16)]
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(cut(a), pa.binary()), pa.array(cut(b), pa.binary())], names=["a", "b"])


def candidate_links(sketch: DataFrame, buckets: int) -> DataFrame:
    """(a, b): star links that connect all sets sharing a band hash."""
    sets = sketch.filter("k is not null").select("k", "bands")
    sent = materialise(sets.mapInArrow(_band_messages(buckets), "bucket int, band binary, a binary, b binary"))
    inside = sent.filter("bucket is null").select("a", "b").mapInArrow(_unpack, "a binary, b binary")
    between = sent.filter("bucket is not null").select("bucket", "band", "a").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_meet, "a binary, b binary")
    return inside.union(between).filter("a <> b").distinct()


def _links(grams: list[np.ndarray], bands: np.ndarray, left: np.ndarray, right: np.ndarray, top: int, bottom: int):
    """Pairs (one of `left`, one of `right`, each pair once) that share a band and have Jaccard >= top / bottom."""
    same = left is right
    sizes = np.array([len(g) for g in grams], np.int64)
    total, dense = len(left) * len(right), None
    shared = np.zeros((len(left), len(right)), bool)
    for band in bands.T:
        shared |= band[left][:, None] == band[right][None, :]
    a, b = sizes[left][:, None], sizes[right][None, :]
    shared &= (np.minimum(a, b) * bottom >= np.maximum(a, b) * top)
    if same:
        shared = np.triu(shared, 1)
    if shared.sum() > max(256, total // 10):  # most pairs are candidates: one product of incidence matrices
        rows = np.concatenate([left, right])
        at, value = np.repeat(np.arange(len(rows)), sizes[rows]), np.concatenate([grams[i] for i in rows])
        order = np.argsort(value, kind="stable")
        at, value = at[order], value[order]
        column = np.cumsum(np.concatenate([[True], value[1:] != value[:-1]])) - 1
        often = np.bincount(column)[column] > 1
        at, column = at[often], column[often]
        dense, width = np.zeros((len(left), len(right)), np.float64), max(1, 2_000_000 // len(rows))
        if len(column):
            cuts = np.searchsorted(column, np.arange(0, column[-1] + width + 1, width))
            for i, j, base in zip(cuts[:-1], cuts[1:], range(0, int(column[-1]) + 1, width), strict=False):
                x = np.zeros((len(rows), width), np.float32)
                x[at[i:j], column[i:j] - base] = 1
                dense += x[:len(left)] @ x[len(left):].T
    out = []
    for i in np.flatnonzero(shared.any(axis=1)):
        js = np.flatnonzero(shared[i])
        mine = grams[left[i]]
        if dense is not None:
            both = np.rint(dense[i, js]).astype(np.int64)
        else:
            theirs = np.concatenate([grams[right[j]] for j in js])
            hit = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
            both = np.add.reduceat(hit, np.concatenate([[0], np.cumsum(sizes[right[js]])[:-1]]), dtype=np.int64)
        ok = both * (top + bottom) >= top * (sizes[left[i]] + sizes[right[js]])
        out += [(left[i], right[j]) for j in js[ok]]
    return out


def _verify(n: int, top: int, bottom: int):
    def verify(table: pa.Table) -> pa.Table:
        keys, comps, parts, copies = (table[c].to_pylist() for c in ("k", "component", "part", "copies"))
        c1, c2 = table["c1"][0].as_py(), table["c2"][0].as_py()
        seen, rows = set(), []
        sets = [g for g in gram_sets(table["text"], n)]
        for i, (k, g) in enumerate(zip(keys, sets, strict=True)):  # another text under the same doc_id is not the one meant
            if k not in seen and len(g) and set_key(g) == k:
                seen.add(k)
                rows.append(i)
        bands = np.frombuffer(b"".join(table["bands"].to_pylist()), np.uint64).reshape(len(keys), -1)
        rows.sort(key=lambda i: comps[i])
        out, i = [], 0
        while i < len(rows):
            j = i
            while j < len(rows) and comps[rows[j]] == comps[rows[i]]:
                j += 1
            mine = np.array(rows[i:j])
            if c1 == c2:
                pairs = _links(sets, bands, mine, mine, top, bottom)
            else:
                side = np.array([parts[r] for r in mine])
                pairs = _links(sets, bands, mine[side == c1], mine[side == c2], top, bottom)
            degree, root = {}, {r: r for r in mine.tolist()}

            def find(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for a, b in pairs:
                a, b = int(a), int(b)
                degree[a], degree[b] = degree.get(a, 0) + copies[b], degree.get(b, 0) + copies[a]
                if find(a) != find(b):
                    root[find(a)] = find(b)
                    out.append((keys[a], keys[b], 0))
            out += [(keys[r], None, d) for r, d in degree.items()]
            i = j
        return pa.table({"a": pa.array([o[0] for o in out], pa.binary()), "b": pa.array([o[1] for o in out], pa.binary()), "links": pa.array([o[2] for o in out], pa.int64())})

    return verify


def near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9995, rows: int = 6) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, text_key, class_id, n_links.

    Two documents are linked if the Jaccard similarity of their sets of word `n`-grams is at
    least `threshold`; words are `[^\\x20\\x09-\\x0D]+`, unchanged. `class_id` is the smallest
    doc_id of a document's component, `n_links` the number of other rows it is linked to, copies
    included. A text of fewer than `n` words is one gram of all its words. Null, empty and
    blank texts have no grams, are linked to nothing and are classes of their own. Null doc_ids
    come last in class_id (null only if the whole class has none). Repeated rows are copies. An empty table gives an empty
    result; other columns are ignored. `text_key` is xxhash64 of the text, to find rows again.
    A link at the threshold is found with probability `recall` or more, a closer one almost surely.
    """
    spark = docs.sparkSession
    bands, rows = band_plan(threshold, recall, rows)
    limit = Fraction(threshold).limit_denominator(1000)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = materialise(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _sketch(n, bands, rows), "doc_id bigint, text_key bigint, k binary, n bigint, bands binary"))
    candidates = materialise(candidate_links(sketch, buckets))
    nodes = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    component = connected_components(nodes, candidates).withColumnRenamed("node", "k")
    every = materialise(sketch.filter("k is not null").groupBy("k").agg(
        F.min("doc_id").alias("first"), F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("rep"), "text_key")).alias("row"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    sets = materialise(every.join(component, "k").select("k", "row.rep", "row.text_key", "copies", "n", "bands", "component"))
    sizes = sets.groupBy("component").agg(F.greatest(F.ceil(F.sum("n") / CHUNK_GRAMS), F.ceil(F.count("*") / CHUNK_SETS)).cast("int").alias("parts"), F.sum("n").alias("grams"))
    bins = F.lit(max(buckets, -(-(sets.agg(F.sum("n")).first()[0] or 0) // CHUNK_GRAMS)))
    cut = sets.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    # small components share a group; the chunks of a large one meet in pairs
    group = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), bins).cast("string")).otherwise(F.hex("component"))
    cut = cut.withColumn("other", other).withColumn("group", group).withColumn("c1", F.least("part", "other")).withColumn("c2", F.greatest("part", "other"))
    # rows of one doc_id and text are one row here, of which there may be many without doc_id
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("rep"), F.xxhash64("text").alias("text_key"), "text").join(cut, ["rep", "text_key"])
    once = Window.partitionBy("rep", "text_key", "part", "other").orderBy(F.lit(0))
    texts = texts.withColumn("again", F.row_number().over(once)).filter(F.col("again") == 1)
    found = materialise(texts.select("group", "c1", "c2", "k", "component", "part", "copies", "bands", "text").groupBy("group", "c1", "c2")
                        .applyInArrow(_verify(n, limit.numerator, limit.denominator), "a binary, b binary, links bigint"))
    forest = found.filter("b is not null").select("a", "b")
    ends = forest.select(F.col("a").alias("node")).union(forest.select("b")).distinct()
    classes = connected_components(ends, forest).select(F.col("node").alias("k"), F.col("component").alias("class"))
    links = found.filter("b is null").groupBy(F.col("a").alias("k")).agg(F.sum("links").alias("links"))
    named = every.select("k", "first", "copies").join(classes, "k", "left").join(links, "k", "left").withColumn("class", F.coalesce("class", "k"))
    least = named.groupBy("class").agg(F.min("first").alias("class_id"))
    named = named.join(least, "class").select("k", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return sketch.select("doc_id", "text_key", "k").join(named, "k", "left").select(
        "doc_id", "text_key", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """`docs` without near duplicates: of each class of `near_duplicates` the row with the smallest doc_id stays.

    Texts without words are no duplicates and stay. Of repeated rows one stays. All columns are kept.
    """
    i, k, row = (fresh(docs, c) for c in ("keep_id", "keep_key", "keep_row"))
    found = near_duplicates(docs, threshold, n)
    stays = found.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.coalesce("doc_id", F.lit(NO_ID)).alias(i), F.col("text_key").alias(k)).distinct()
    keyed = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(i), F.xxhash64(F.col("text").cast("string")).alias(k))
    place = Window.partitionBy(i, k).orderBy(F.lit(0))
    blank = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]")) == 0
    one = keyed.join(stays, [i, k], "left_semi").withColumn(row, F.row_number().over(place)).filter((F.col(row) == 1) | blank)
    return one.select(*(F.col(f"`{c}`") for c in docs.columns))
