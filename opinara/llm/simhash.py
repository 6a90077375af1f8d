"""SimHash near duplicates by multi-index hashing.

A text's 64-bit fingerprint is the majority of the hashes of its word shingles, bit by bit. Equal fingerprints are one
node. Fingerprints are cut into m segments, and each segment has a table. If two fingerprints differ in
r bits at most, with r = f * m + a, then some of the first a + 1 segments differ in f bits at most, or some
of the others in f - 1. So every node looks up, in each table, the small Hamming ball around its segment, and
the complete distance of each match is verified. m is the cheapest for the number of nodes.

Tables and lookups are dealt by segment value. Entries under a value that many nodes share, and under the values around it, are cut into
chunks, and the chunks of table and lookups meet in pairs, so that no task takes a whole hot value. A task does not hand on all the links it
verifies but a spanning forest of them. Classes are the components of these forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.operators.dbscan import connected_components
from opinara.session import materialise

BITS = 64
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_HASHES = 1 << 16  # hashes whose bits are spread out at once
PACK = 50_000  # nodes whose lookups a task sorts at once
BIN_LOOKUPS = 2_000_000  # lookups of one group
CHUNK = 4096  # table entries under one value that a task takes whole; lookups go by 16 times as many
SLICE_PAIRS = 4_000_000
LOOKUP_COST = 64  # comparisons that cost as much as sending one lookup


def shingle_hashes(text: Column, n: int) -> Column:
    """XXH64 with seed 42 of each `n`-word shingle of the lower-cased text; fewer words are one shingle, none give none."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))

    def shingles(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(w, i, n), " "))))

    return F.transform(F.array(words), shingles)[0]  # binds the words, so that they are split once


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of hashes: the bits set in more than half of them; 0 for an empty run."""
    votes = np.zeros((len(offsets) - 1, BITS), np.int64)
    sizes = np.diff(offsets)
    for start in range(0, len(hashes), SLICE_HASHES):
        stop = min(start + SLICE_HASHES, len(hashes))
        bits = np.unpackbits(np.ascontiguousarray(hashes[start:stop]).astype(">u8").view(np.uint8)).reshape(-1, BITS)
        low, high = np.searchsorted(offsets, start, "right") - 1, np.searchsorted(offsets, stop, "left")
        runs = np.flatnonzero(sizes[low:high] > 0) + low
        cuts = np.maximum(offsets[runs] - start, 0)
        votes[runs] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > sizes[:, None], axis=1).view(">u8")[:, 0].astype(np.uint64)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        found = majority(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), offsets - offsets[0])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingle_hashes(F.col("text"), n).alias("h"))
    return rows.mapInArrow(_prints, "doc_id bigint, fp bigint")


def segments(m: int, radius: int) -> list[tuple[int, int, np.ndarray]]:
    """(shift, width, masks) for each of `m` segments; the masks are the ball that is looked up."""
    f, a = divmod(radius, m)
    out, shift = [], 0
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        ball = f if i <= a else f - 1
        masks = [sum(1 << b for b in c) for k in range(ball + 1) for c in combinations(range(width), k)]
        out.append((shift, width, np.array(masks, np.uint64)))
        shift += width
    return out


def best_split(nodes: int, radius: int) -> int:
    """The number of segments with the least lookups and expected comparisons."""
    def cost(m: int) -> float:
        f, a = divmod(radius, m)
        width = BITS // m
        balls = [sum(comb(width, k) for k in range((f if i <= a else f - 1) + 1)) for i in range(m)]
        return sum(balls) * (LOOKUP_COST + nodes / 2 ** width)

    return min(range(2, 9), key=cost)


def _keys(fp: np.ndarray, i: int, shift: int, width: int) -> np.ndarray:
    """The segment's value with its number above it (values have at most 32 bits)."""
    return ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)) | np.uint64(i << 32)


def _bin(keys: np.ndarray, bins: int) -> np.ndarray:
    x = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)


def _entries(cut: list[tuple[int, int, np.ndarray]], lookups: bool):
    """(key, fp) of every node, in each table or, with `lookups`, in each place that it looks up."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (shift, width, masks) in enumerate(cut):
                own = _keys(fp, i, shift, width)
                for mask in masks if lookups else (np.uint64(0),):
                    yield pa.RecordBatch.from_arrays([pa.array((own ^ mask).view(np.int64)), batch.column(0)], names=["key", "fp"])

    return entries


def _pack(cut: list[tuple[int, int, np.ndarray]], bins: int, lookups: bool):
    """(bin, keys, fps): the entries of a task's nodes, packed by bin."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(whole), PACK):
                fp = whole[start:start + PACK]
                for i, (shift, width, masks) in enumerate(cut):
                    own = _keys(fp, i, shift, width)
                    for some in np.array_split(masks if lookups else masks[:1], ceil(len(masks) / 64) if lookups else 1):
                        keys = (own[:, None] ^ some[None, :]).ravel()
                        at = _bin(keys, bins)
                        order = np.argsort(at, kind="stable")
                        keys, mine, at = keys[order], fp[order // len(some)], at[order]
                        ends = np.flatnonzero(np.concatenate([at[1:] != at[:-1], [True]])) + 1
                        starts = np.concatenate([[0], ends[:-1]])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(at[starts], pa.int32()), pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                            pa.array([mine[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())], names=["bin", "keys", "fps"])

    return pack


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that connect what the links (a, b) connect."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for end in (x, y):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def links(table_keys: np.ndarray, table: np.ndarray, keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the pairs under one key that differ in at most `radius` bits."""
    order = np.argsort(table_keys, kind="stable")
    table_keys, table = table_keys[order], table[order]
    low, high = np.searchsorted(table_keys, keys), np.searchsorted(table_keys, keys, "right")
    hit = high > low
    low, count, fps = low[hit], (high - low)[hit], fps[hit]
    total = np.concatenate([[0], np.cumsum(count)])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    i = 0
    while i < len(fps):
        j = max(i + 1, int(np.searchsorted(total, total[i] + SLICE_PAIRS, "right")) - 1)
        n = count[i:j]
        left = np.repeat(fps[i:j], n)
        right = table[np.arange(total[j] - total[i]) - np.repeat(total[i:j] - total[i], n) + np.repeat(low[i:j], n)]
        ok = (np.bitwise_count(left ^ right) <= radius) & (left < right)
        found.append(forest(left[ok], right[ok]))
        i = j
    return forest(*(np.concatenate(c) for c in zip(*found, strict=True))) if found else (fps[:0], fps[:0])


def _link_table(found: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    return pa.table({"a": pa.array(found[0].view(np.int64)), "b": pa.array(found[1].view(np.int64))})


def _meet(radius: int):
    def meet(table: pa.Table, asked: pa.Table) -> pa.Table:
        join = lambda t, c: np.frombuffer(b"".join(t[c].to_pylist()), np.uint64)
        return _link_table(links(*(join(t, c) for t in (table, asked) for c in ("keys", "fps")), radius))

    return meet


def _meet_chunks(radius: int):
    def meet(table: pa.Table, asked: pa.Table) -> pa.Table:
        plain = lambda t, c: t[c].to_numpy().view(np.uint64)
        return _link_table(links(*(plain(t, c) for t in (table, asked) for c in ("key", "fp")), radius))

    return meet


def _around(keys: DataFrame, cut: list[tuple[int, int, np.ndarray]]) -> DataFrame:
    """(key, near): every key of the balls around `keys`."""
    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (_, _, masks) in enumerate(cut):
                mine = key[key >> np.uint64(32) == i]
                for mask in masks:
                    yield pa.RecordBatch.from_arrays([pa.array(mine.view(np.int64)), pa.array((mine ^ mask).view(np.int64))], names=["key", "near"])

    return keys.select("key").mapInArrow(balls, "key bigint, near bigint")


def near_pairs(nodes: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links that connect all of the distinct fingerprints `nodes` (fp) whose chains of steps of at most `radius` bits connect them.

    A value that more than `chunk` nodes share is hot; nothing is left out for it.
    """
    spark = nodes.sparkSession
    nodes = nodes.select("fp")
    n = nodes.count()
    cut = segments(best_split(n, radius), radius)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins = max(width, n * sum(len(masks) for _, _, masks in cut) // BIN_LOOKUPS)
    table = nodes.mapInArrow(_entries(cut, False), "key bigint, fp bigint")
    counts = table.groupBy("key").agg(F.count("*").alias("n"))
    hot = materialise(counts.filter(F.col("n") > chunk))
    packed = "bin int, keys binary, fps binary"
    held, asked = nodes.mapInArrow(_pack(cut, bins, False), packed), nodes.mapInArrow(_pack(cut, bins, True), packed)
    if hot.isEmpty():
        return held.groupBy("bin").cogroup(asked.groupBy("bin")).applyInArrow(_meet(radius), "a bigint, b bigint")
    # hot values and those around them are searched in chunks; the rest as before, but without their table entries
    special = _around(hot, cut).select(F.col("near").alias("key")).distinct().join(counts, "key")
    special = materialise(special)
    calls = _around(special, cut).join(counts.select(F.col("key").alias("near"), F.col("n").alias("m")), "near").groupBy("key").agg(F.sum("m").alias("m"))
    plan = materialise(special.join(calls, "key").select("key", F.ceil(F.col("n") / chunk).cast("int").alias("tables"), F.ceil(F.col("m") / (16 * chunk)).cast("int").alias("callers")))
    part = lambda of: F.pmod(F.xxhash64("fp"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    chunked = table.join(plan, "key").select("key", "fp", part("tables").alias("t"), every("callers").alias("c"))
    callers = nodes.mapInArrow(_entries(cut, True), "key bigint, fp bigint").join(plan, "key").select("key", "fp", part("callers").alias("c"), every("tables").alias("t"))
    group = ["key", "t", "c"]
    large = chunked.groupBy(*group).cogroup(callers.groupBy(*group)).applyInArrow(_meet_chunks(radius), "a bigint, b bigint")
    rest = table.join(plan, "key", "left_anti").mapInArrow(_rebin(bins), packed)
    small = rest.groupBy("bin").cogroup(asked.groupBy("bin")).applyInArrow(_meet(radius), "a bigint, b bigint")
    return small.union(large)


def _rebin(bins: int):
    """Plain entries, packed by bin."""
    def rebin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps = (c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns)
            at = _bin(keys, bins)
            order = np.argsort(at, kind="stable")
            keys, fps, at = keys[order], fps[order], at[order]
            ends = np.flatnonzero(np.concatenate([at[1:] != at[:-1], [True]])) + 1 if len(at) else np.empty(0, int)
            starts = np.concatenate([[0], ends[:-1]]) if len(at) else ends
            yield pa.RecordBatch.from_arrays([pa.array(at[starts], pa.int32()), *(pa.array([x[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()) for x in (keys, fps))],
                                             names=["bin", "keys", "fps"])

    return rebin


def near_duplicates(docs: DataFrame, radius: int = 4, n: int = 4, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs` (doc_id, text).

    `fingerprint` is 16 hexadecimal digits; documents whose fingerprints differ in at most `radius` bits are linked, and
    component_id is the smallest doc_id that links reach, the own one included. Texts are lower-cased (A to Z only) and cut into
    words `[^\\x20\\x09-\\x0D]+` and `n`-word shingles, repeats included; a shorter text is one shingle. Null, empty and blank texts have
    fingerprint zero and are linked like any other. Null doc_ids count last in component_id (null only if no row of the component
    has one). Repeated rows are rows of their own. An empty table gives an empty result; other columns are ignored.
    """
    prints = materialise(fingerprints(docs, n))
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = materialise(near_pairs(nodes, radius, chunk).distinct())
    ends = found.select(F.col("a").alias("node")).union(found.select("b")).distinct()
    component = connected_components(ends, found)
    linked = nodes.join(component, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
