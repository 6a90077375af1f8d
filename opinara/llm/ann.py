"""Approximate nearest neighbours with a hash-prefix forest, Euclidean distance.

Each of `trees` trees gives a vector a long string of bits: sides of random hyperplanes through
the medians of a sample. A tree is a sorted array of these strings. A query descends in each
tree to its longest common prefix by binary search, then all trees ascend together, one bit
at a time, until the rows under the prefixes number `candidates`. The trees' arrays are
dealt by (tree, first bits). Queries that find fewer than `candidates` rows under these bits, in
thin regions, go through further rounds with half as many bits, at the end with none, where one tree holds
every row. Large parts are cut into chunks of bounded size, as are the queries that visit them.

`candidates` and the depth of the deal are fitted: for a bounded sample of rows the exact
neighbours are found by one pass over all rows, and the smallest number of candidates that
finds `recall` of them is taken, at least `k + 1` for each tree, so that some tree has k other rows. Data without any structure, such as random directions in many
dimensions, need a large share of all rows for that.

Inside a part vectors are compared as 8-bit codes, stored with their distance from the vector. By the
triangle inequality that bounds the true distance from both sides: every row that can be among the k nearest of
its part is compared again by the exact distance of the original vectors, in double precision.
Equal vectors are searched once and opened up at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import materialise

TREES, BITS = 24, 32
SAMPLE, PROBES = 4096, 64  # rows that set the medians; rows whose exact neighbours fit the forest
TASK_ROWS, CHUNK_ROWS, CHUNK_QUERIES = 32_768, 250_000, 4096
MAX_DEAL = 16
SLICE = 16_384  # rows that are decoded at once

PART = "tree int, block int, labels binary, ids binary, scales binary, errors binary, codes binary"


class Forest(NamedTuple):
    planes: np.ndarray  # dimensions x (trees * bits)
    medians: np.ndarray
    depth: int  # bits by which arrays are dealt
    candidates: int
    expected: float  # recall on the probes


def labels_of(x: np.ndarray, planes: np.ndarray, medians: np.ndarray) -> np.ndarray:
    """rows x trees: the bit strings, first bit highest."""
    bits = (x @ planes > medians).reshape(len(x), -1, BITS)
    return np.packbits(bits, axis=2).view(">u4")[:, :, 0].astype(np.uint32)


def prefix_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of bit strings."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(((q - x) ** 2).sum(axis=-1))


def distinct_vectors(vectors: DataFrame, vec_id: str, embedding: str, members: int) -> tuple[DataFrame, DataFrame]:
    """(sets, rows): each vector once with its `members` smallest ids, and all valid rows (id, vec).

    Null and zero vectors, vectors with null or non-finite components, rows without id and vectors of
    another length than the most common one take no part. Repeated rows count once.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull()).filter(F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.filter(F.size("vec") == F.lit(common[0] if common else 0))
    place = Window.partitionBy("vec").orderBy("id")
    first = rows.withColumn("r", F.rank().over(place)).filter(F.col("r") <= members).groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return materialise(first.withColumn("rep", F.col("ids")[0])), rows


def _exact_pass(queries: np.ndarray, own: list[int], k: int):
    """The k nearest rows of a task for each probe."""
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0), np.empty(0, np.int64))] * len(queries)
        for batch in batches:
            ids, x = np.asarray(batch.column(0)), _matrix(batch.column(1))
            for i, q in enumerate(queries):
                d = distances(q, x)
                d[ids == own[i]] = np.inf
                near = np.argpartition(d, min(k, len(d) - 1))[:k]
                d, n = np.concatenate([best[i][0], d[near]]), np.concatenate([best[i][1], ids[near]])
                order = np.lexsort((n, d))[:k]
                best[i] = d[order], n[order]
        sizes = [len(b[0]) for b in best]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(queries)), sizes), pa.int32()), pa.array(np.concatenate([b[1] for b in best])), pa.array(np.concatenate([b[0] for b in best]))], names=["probe", "rep", "d"])

    return nearest


def _depth_pass(planes: np.ndarray, medians: np.ndarray, probes: np.ndarray):
    """Rows at each common prefix length with each probe, over all trees."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(probes), BITS + 1), np.int64)
        for batch in batches:
            mine = labels_of(_matrix(batch.column(0)), planes, medians)
            for i, p in enumerate(probes):
                total[i] += np.bincount(prefix_length(mine, p[None, :]).ravel(), minlength=BITS + 1)
        at = np.arange(len(probes) * (BITS + 1))
        yield pa.RecordBatch.from_arrays([pa.array(at // (BITS + 1), pa.int32()), pa.array(at % (BITS + 1), pa.int32()), pa.array(total.ravel())], names=["probe", "depth", "n"])

    return count


def fit_forest(sets: DataFrame, k: int, recall: float, trees: int = TREES, seed: int = 11) -> Forest:
    """Hyperplanes from `SAMPLE` rows; candidates and depth from `PROBES` rows searched exactly among all rows."""
    sample = sets.select("rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).collect()
    x = np.array([r["vec"] for r in sample], np.float64)
    planes = np.random.default_rng(seed).standard_normal((x.shape[1], trees * BITS))
    medians = np.median(x @ planes, axis=0)
    probes, own = x[:PROBES], [r["rep"] for r in sample[:PROBES]]
    near = sets.select("rep", "vec").mapInArrow(_exact_pass(probes, own, k), "probe int, rep bigint, d double")
    place = Window.partitionBy("probe").orderBy("d", "rep")
    truth = near.withColumn("r", F.row_number().over(place)).filter((F.col("r") <= k) & (F.col("d") < float("inf"))).select("probe", "rep")
    found = truth.join(sets, "rep").select("probe", "vec").collect()
    if not found:
        return Forest(planes, medians, 0, 1, 1.0)
    at = np.array([r["probe"] for r in found])
    mine = labels_of(probes, planes, medians)
    reach = prefix_length(labels_of(np.array([r["vec"] for r in found], np.float64), planes, medians), mine[at]).max(axis=1)
    rows = sets.select("vec").mapInArrow(_depth_pass(planes, medians, mine), "probe int, depth int, n bigint").groupBy("probe", "depth").agg(F.sum("n")).collect()
    under = np.zeros((len(probes), BITS + 1), np.int64)
    for p, d, n in rows:
        under[p, d] = n
    under = under[:, ::-1].cumsum(axis=1)[:, ::-1]  # rows with at least this much in common
    some = np.unique(under)
    for candidates in some[some >= min(trees * (k + 1), some[-1])]:
        depth = BITS - np.argmax(under[:, ::-1] >= candidates, axis=1)
        hit = (reach >= depth[at]).mean()
        if hit >= recall:
            break
    return Forest(planes, medians, int(min(MAX_DEAL, depth.min())), int(candidates), float(hit))


def _parts(f: Forest):
    """Rows of a task, dealt by tree and first bits, with 8-bit codes of their vectors."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            scales = np.abs(x).max(axis=1) / 127
            codes = np.rint(x / np.maximum(scales, np.finfo(np.float64).tiny)[:, None]).clip(-127, 127).astype(np.int8)
            errors = np.nextafter(distances(x, scales[:, None] * codes).astype(np.float32), np.float32(np.inf))
            mine, rows = labels_of(x, f.planes, f.medians), []
            for t in range(mine.shape[1]):
                order = np.argsort(mine[:, t], kind="stable")
                label = mine[order, t]
                block = label.astype(np.int64) >> (BITS - f.depth)
                cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
                for i, j in zip(cut[:-1], cut[1:], strict=True):
                    o = order[i:j]
                    rows.append((t, int(block[i]), label[i:j].tobytes(), ids[o].tobytes(), scales[o].tobytes(), errors[o].tobytes(), codes[o].tobytes()))
            kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=["tree", "block", "labels", "ids", "scales", "errors", "codes"])

        held, n = [], 0
        for batch in batches:
            if len(batch):
                held.append((np.asarray(batch.column(0)), _matrix(batch.column(1))))
                n += len(batch)
            if n >= TASK_ROWS:
                yield flush(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held, n = [], 0
        if held:
            yield flush(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return deal


def _query_parts(f: Forest):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            mine = labels_of(x, f.planes, f.medians)
            n, trees = mine.shape
            block = mine.astype(np.int64) >> (BITS - f.depth)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t), pa.int32()), pa.array(block[:, t], pa.int32()), batch.column(0), pa.array(mine[:, t].astype(np.int64)), batch.column(1)], names=["tree", "block", "query", "label", "vec"])

    return deal


def _arrays(table: pa.Table, dims: int | None = None):
    join = lambda c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
    labels = join("labels", np.uint32)
    order = np.argsort(labels, kind="stable")
    if dims is None:
        return labels[order]
    codes = join("codes", np.int8).reshape(-1, dims)
    return labels[order], join("ids", np.int64)[order], join("scales", np.float64)[order], join("errors", np.float32)[order], codes[order]


def _range(labels: np.ndarray, label: int, depth: int) -> tuple[int, int]:
    """Where the strings that share `depth` bits with `label` lie in the sorted array."""
    low = label >> (BITS - depth) << (BITS - depth)
    return int(np.searchsorted(labels, np.uint32(low))), int(np.searchsorted(labels, np.uint32(low + (1 << (BITS - depth)) - 1), "right"))


def _descend(dealt: int):
    """For each query how many rows of a part share 0, 1, ... bits with it."""
    def count(part: pa.Table, queries: pa.Table) -> pa.Table:
        labels, wanted = _arrays(part), queries["label"].to_numpy()
        out = np.zeros((len(wanted), BITS + 1), np.int64)
        for d in range(dealt, BITS + 1) if len(labels) else ():
            low = wanted >> (BITS - d) << (BITS - d)
            high = low + (1 << (BITS - d)) - 1
            out[:, d] = np.searchsorted(labels, high.astype(np.uint32), "right") - np.searchsorted(labels, low.astype(np.uint32))
        return pa.table({"query": queries["query"], "under": pa.array(out.tolist(), pa.list_(pa.int64()))})

    return count


def _search(dims: int, k: int):
    """For each query the rows under its prefix that can be among its k nearest of the part."""
    def bounds(q: np.ndarray, scales: np.ndarray, errors: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = codes * scales[:, None]
        d = distances(q, x)
        # the last terms cover the rounding of the sums themselves
        slack = errors + 1e-9 * (d + np.abs(q).max() + scales * 127)
        return d - slack, d + slack

    def search(part: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_r = [], []
        if part.num_rows and queries.num_rows:
            labels, ids, scales, errors, codes = _arrays(part, dims)
            for query, label, depth, vec in zip(*(queries[c].to_pylist() for c in ("query", "label", "depth", "vec")), strict=True):
                i, j = _range(labels, label, depth)
                if i == j:
                    continue
                q = np.array(vec, np.float64)
                low, high = (np.concatenate(c) for c in zip(*(bounds(q, *(c[a:min(a + SLICE, j)] for c in (scales, errors, codes))) for a in range(i, j, SLICE)), strict=True))
                own = ids[i:j] == query
                high[own] = np.inf
                kth = np.partition(high, k - 1)[k - 1] if len(high) >= k else np.inf
                best = ids[i:j][~(low > kth) & ~own]
                out_q.append(np.full(len(best), query))
                out_r.append(best)
        empty = [np.empty(0, np.int64)]
        return pa.table({"query": np.concatenate(out_q or empty).astype(np.int64), "rep": np.concatenate(out_r or empty)})

    return search


def _rounds(parts: DataFrame, ask: DataFrame, f: Forest, dims: int, k: int) -> DataFrame:
    """(query, rep): the rows to compare exactly for each query, found in rounds over shallower and shallower parts."""
    near, dealt = None, f.depth
    while True:
        at = F.shiftright("block", f.depth - dealt)
        held, asked = parts.withColumn("block", at), ask.withColumn("block", at)
        if dealt == 0 and f.depth > 0:  # every tree holds every row here
            held, asked = held.filter("tree = 0"), asked.filter("tree = 0")
        deal = ["tree", "block"]
        sizes = held.groupBy(*deal).agg(F.ceil(F.sum(F.octet_length("labels") / 4) / CHUNK_ROWS).cast("int").alias("chunks"))
        crowd = asked.groupBy(*deal).agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("int").alias("crowds"))
        plan = sizes.join(crowd, deal)
        chunk, crowds = F.pmod(F.xxhash64("labels"), F.col("chunks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("crowds") - 1))
        cut = held.join(plan, deal).withColumn("chunk", chunk).withColumn("crowd", crowds)
        each = F.pmod(F.xxhash64("query"), F.col("crowds")).cast("int")
        asking = asked.join(plan, deal).withColumn("crowd", each).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        group = [*deal, "chunk", "crowd"]
        if dealt == 0 and f.depth > 0:
            depths = asked.select("query", F.lit(0).alias("depth"))
        else:
            counts = cut.select(*group, "labels").groupBy(*group).cogroup(asking.select(*group, "query", "label").groupBy(*group)) \
                .applyInArrow(_descend(dealt), "query bigint, under array<bigint>")
            total = counts.groupBy("query").agg(*(F.sum(F.col("under")[d]).alias(f"d{d}") for d in range(BITS + 1)))
            # the longest prefix with enough rows under it, over all trees
            depth = F.coalesce(*(F.when(F.col(f"d{d}") >= f.candidates, F.lit(d)) for d in range(BITS, dealt - 1, -1)))
            depths = materialise(total.select("query", (F.coalesce(depth, F.lit(0)) if dealt == 0 else depth).alias("depth")))
        going = asking.join(depths.filter("depth is not null"), "query").select(*group, "query", "label", "depth", "vec")
        found = cut.select(*group, "labels", "ids", "scales", "errors", "codes").groupBy(*group).cogroup(going.groupBy(*group)).applyInArrow(_search(dims, k), "query bigint, rep bigint")
        near = found if near is None else near.union(found)
        thin = depths.filter("depth is null").select("query")
        if dealt == 0 or thin.isEmpty():
            return near
        ask, dealt = materialise(ask.join(thin, "query", "left_semi")), dealt // 2


def search(vectors: DataFrame, is_query, k: int = 10, recall: float = 0.95, trees: int = TREES, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where `is_query` (a condition on the id) holds.

    `score` is the Euclidean distance of the original vectors in double precision, ties go to
    the smaller vec_id, and a query is not its own neighbour. With fewer than k other rows all of them
    are returned. See `distinct_vectors` for rows that take no part; an empty table gives an empty result; extra columns
    are ignored. `recall` is what the fitted forest finds on its probes.
    """
    spark = vectors.sparkSession
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    sets, rows = distinct_vectors(vectors, vec_id, embedding, k + 1)
    some = sets.first()
    if some is None:
        return spark.createDataFrame([], empty)
    dims = len(some["vec"])
    f = fit_forest(sets, k, recall, trees)
    asked = materialise(rows.filter(is_query(F.col("id"))).distinct().join(sets.select("vec", "rep"), "vec").select(F.col("id").alias("query_id"), "rep"))
    wanted = sets.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "vec")
    parts = materialise(sets.select("rep", "vec").mapInArrow(_parts(f), PART))
    ask = materialise(wanted.mapInArrow(_query_parts(f), "tree int, block int, query bigint, label bigint, vec array<float>" if "float" in dict(sets.dtypes)["vec"] else "tree int, block int, query bigint, label bigint, vec array<double>"))
    near = _rounds(parts, ask, f, dims, k)
    own = wanted.select(F.col("rep").alias("query"), "rep")
    pairs = near.union(own).distinct()
    there, here = sets.alias("t"), wanted.select(F.col("rep").alias("query"), F.col("vec").alias("q"))
    apart = F.sqrt(F.aggregate(F.zip_with("q", "vec", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, v: s + v))
    scored = pairs.join(there, "rep").join(here, "query").select("query", "ids", apart.alias("score"))
    hits = scored.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("score", F.col("ids")[0]))).filter(F.col("r") <= k + 1)
    opened = asked.withColumnRenamed("rep", "query").join(hits, "query").select("query_id", "score", F.explode("ids").alias("vec_id")).filter(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return opened.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) by comparing every query with every row; for measuring recall on small tables."""
    _, rows = distinct_vectors(vectors, vec_id, embedding, k + 1)
    q, x = rows.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("vec").alias("q")).collect(), rows.distinct()
    ids, vecs = [r["query_id"] for r in q], np.array([r["q"] for r in q], np.float64)
    near = x.mapInArrow(_exact_pass(vecs, ids, k), "probe int, rep bigint, d double") if ids else x.select(F.lit(0).alias("probe"), F.col("id").alias("rep"), F.lit(0.0).alias("d")).limit(0)
    order = Window.partitionBy("probe").orderBy("d", "rep")
    name = F.element_at(F.array(*(F.lit(i) for i in ids or [0])), F.col("probe") + 1)
    return near.filter(F.col("d") < float("inf")).withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k) \
        .select(name.alias("query_id"), "rank", F.col("rep").alias("vec_id"), F.col("d").alias("score"))
