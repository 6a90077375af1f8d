"""Nearest neighbours over dense vectors: exact, inverted lists, hashing.

All methods share one step: queries and items meet in cells, every (cell, query
chunk, item chunk) is one bounded matrix product inside a task, and only each
query's best `k` of the chunk leave it. Cells with many rows are cut into more
chunks, so a hot cell is spread over tasks.

The methods differ in which cells a query visits:

* exact: the cells of nearest pivots; after its own cell a query visits just the
  cells that the triangle inequality cannot rule out. These are visited in groups of
  neighbouring cells, so a query travels once to each group and not to each cell.
* inverted lists: the `n_probe` nearest k-means cells.
* hashing: the query's bucket in each of several random-hyperplane tables.

Vectors that are equal are searched once (see `scores.expand_classes`).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.vectors import as_doubles, l2_normalise, norm
from opinara.operators.scores import expand_classes, place_members
from opinara.operators.toprows import seeded_sample, top_n_per_key
from opinara.session import materialise, width

CHUNK = 2048
GROUP = 8192  # items of a group of cells that queries visit together
SLICE = 256  # rows that are multiplied at once
MAX_PIVOTS = 1024
CELL_ROWS = 512  # wanted items per pivot cell
DIGITS = 9
SLACK = 1e-6  # keeps rounding from ruling out a cell that holds a tie

METRICS = ("cosine", "ip", "l2")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _rounded(x: np.ndarray) -> np.ndarray:
    """Halves away from zero, as SQL rounds."""
    unit = 10.0 ** DIGITS
    return np.copysign(np.floor(np.abs(x) * unit + 0.5) / unit, x)


def _best_places(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the `k` largest of each row, ties to the lower column."""
    behind = np.where(np.isnan(score), np.inf, -score)
    if score.shape[1] > k:
        rows, cols = np.nonzero(behind <= np.partition(behind, k - 1, axis=1)[:, k - 1:k])
    else:
        rows, cols = (x.ravel() for x in np.indices(score.shape))
    order = np.lexsort((cols, behind[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows)
    kept = np.arange(len(rows)) - first < k
    return rows[kept], cols[kept]


def _chunk_search(k: int, metric: str, open_parts=None):
    """Best `k` items of one chunk for each query of one chunk, scored in slices of bounded size.

    `open_parts(queries, parts)` tells which of the items' `part`s a query visits; its list then
    holds only what reaches the query's `kth` score.
    """

    def search(queries: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or items.empty:
            return pd.DataFrame({"query": queries["query"][:0], "item": items["item"][:0], "score": np.empty(0)})
        items = items.sort_values("item" if open_parts is None else ["part", "item"], kind="stable")
        x, names = _matrix(items["vec"]), items["item"].to_numpy()
        squares = (x * x).sum(axis=1)
        cuts, parts = np.array([0, len(x)]), None
        if open_parts is not None:
            parts, starts = np.unique(items["part"].to_numpy(), return_index=True)
            cuts = np.append(starts, len(x))
        out = []
        for start in range(0, len(queries), SLICE):
            asked = queries.iloc[start:start + SLICE]
            q, found = _matrix(asked["qvec"]), []
            visits = None if open_parts is None else open_parts(asked, parts)
            for p, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                mine = np.arange(len(q)) if visits is None else np.flatnonzero(visits[:, p])
                for c in range(i, j, CHUNK) if len(mine) else ():
                    e = min(c + CHUNK, j)
                    score = q[mine] @ x[c:e].T
                    if metric == "l2":
                        score = 2 * score - (q[mine] * q[mine]).sum(axis=1)[:, None] - squares[None, c:e]
                        score = np.minimum(score, 0.0)
                    score = _rounded(score)
                    rows, cols = _best_places(score, k)
                    found.append((mine[rows], c + cols, score[rows, cols]))
            if not found:
                continue
            rows, cols, score = (np.concatenate(v) for v in zip(*found, strict=True))
            if open_parts is not None:
                kth = asked["kth"].to_numpy(dtype=np.float64)[rows]
                near = ~(score < kth - 1e-8 * (1 + np.abs(kth)))  # without a k-th score everything is near
                rows, cols, score = rows[near], cols[near], score[near]
            if len(found) > 1:
                order = np.lexsort((names[cols], -score, rows))
                rows, cols, score = rows[order], cols[order], score[order]
                kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
                rows, cols, score = rows[kept], cols[kept], score[kept]
            out.append((asked["query"].to_numpy()[rows], names[cols], score))
        if not out:
            return pd.DataFrame({"query": queries["query"][:0], "item": items["item"][:0], "score": np.empty(0)})
        return pd.DataFrame(dict(zip(("query", "item", "score"), (np.concatenate(v) for v in zip(*out, strict=True)), strict=True)))

    return search


def search_cells(queries: DataFrame, items: DataFrame, k: int, metric: str, chunk: int = CHUNK, open_parts=None) -> DataFrame:
    """Top `k` per query over the cells it visits: `query`, `item`, `score`.

    queries: (cell, query, qvec); items: (cell, item, vec). The score is the dot
    product, or minus the squared distance for "l2". A pair met in several cells
    comes out once per cell. With `open_parts` items have a `part`, and queries the
    columns that it looks at (see `_chunk_search`).
    """
    parts = lambda df, n: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias(n))
    sizes = F.broadcast(parts(items, "n_i").join(parts(queries, "n_q"), "cell"))  # one row per cell
    slot = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = queries.join(sizes, "cell").select("cell", slot("query", "n_q").alias("qp"), every("n_i").alias("ip"), *[c for c in queries.columns if c != "cell"])
    x = items.join(sizes, "cell").select("cell", every("n_q").alias("qp"), slot("item", "n_i").alias("ip"), *[c for c in items.columns if c != "cell"])
    qt, it = dict(queries.dtypes)["query"], dict(items.dtypes)["item"]
    keys = ["cell", "qp", "ip"]
    search = _chunk_search(k, metric, open_parts)
    tasks = max(width(queries), width(items))
    q, x = q.repartition(tasks, *keys), x.repartition(tasks, *keys)
    return q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInPandas(
        lambda a, b: search(a, b), schema=f"query {qt}, item {it}, score double"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    return top_n_per_key(found.dropDuplicates(["query", "item"]), ["query"], [F.desc("score"), F.asc("item")], k)


def _prepared(df: DataFrame, metric: str, id_name: str, vec_name: str, id_col: str, vec_col: str) -> DataFrame:
    v = l2_normalise(vec_col) if metric == "cosine" else as_doubles(vec_col)
    return df.select(F.col(id_col).alias(id_name), v.alias(vec_name))


def _nearest(pivots: np.ndarray, vec: str, keep: list[str], n: int = 1):
    """Add each row's `n` nearest pivots as `cell` with the distance `to_pivot`."""

    def run(batches):
        squares = (pivots * pivots).sum(axis=1)
        for pdf in (whole.iloc[i:i + CHUNK] for whole in batches for i in range(0, len(whole), CHUNK)):
            v = _matrix(pdf[vec])
            d2 = np.maximum((v * v).sum(axis=1)[:, None] + squares[None, :] - 2 * v @ pivots.T, 0.0)
            near = np.where(np.isnan(d2), np.inf, d2).argmin(axis=1)[:, None] if n == 1 else np.argsort(d2, axis=1, kind="stable")[:, :n]
            out = pdf[keep].iloc[np.repeat(np.arange(len(pdf)), near.shape[1])].reset_index(drop=True)
            out["cell"] = near.ravel().astype("int32")
            out["to_pivot"] = np.sqrt(np.take_along_axis(d2, near, axis=1).ravel())
            yield out

    return run


def _pivots(items: DataFrame, count: int) -> np.ndarray:
    rows = seeded_sample(items, "item", count).collect()  # at most MAX_PIVOTS vectors
    return np.array([r["vec"] for r in sorted(rows, key=lambda r: r["item"])], dtype=np.float64)


def exact_search(queries: DataFrame, items: DataFrame, k: int, metric: str, n_pivots: int | None = None) -> DataFrame:
    """Exact top `k`: `query`, `item`, `score`, `rank`. Vectors must suit the metric already."""
    n = items.count()
    count = n_pivots or max(1, min(MAX_PIVOTS, n // CELL_ROWS))
    item_sq = 1.0  # squared length no item exceeds
    if metric == "ip":
        # Inner product order equals distance order once items share one length:
        # an extra coordinate tops every item up to the longest, queries get 0.
        longest = items.agg(F.max(norm("vec")).alias("m")).first()["m"] or 0.0
        item_sq = longest * longest
        lift = F.sqrt(F.greatest(F.lit(item_sq) - norm("vec") * norm("vec"), F.lit(0.0)))
        items = items.withColumn("vec", F.concat("vec", F.array(lift)))
        queries = queries.withColumn("qvec", F.concat("qvec", F.array(F.lit(0.0))))
    it, qt = dict(items.dtypes)["item"], dict(queries.dtypes)["query"]
    if n == 0:
        return queries.select("query", F.lit(None).cast(it).alias("item"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).limit(0)
    pivots = _pivots(items, count)
    xs = materialise(items.mapInPandas(_nearest(pivots, "vec", ["item", "vec"]), f"item {it}, vec array<double>, cell int, to_pivot double"))
    qs = materialise(queries.mapInPandas(_nearest(pivots, "qvec", ["query", "qvec"]), f"query {qt}, qvec array<double>, cell int, to_pivot double"))
    cells = sorted(xs.groupBy("cell").agg(F.max("to_pivot").alias("r"), F.count(F.lit(1)).alias("n")).collect())  # one row per pivot
    used = np.array([c["cell"] for c in cells], dtype=np.int64)
    points = pivots[used]

    own = materialise(_best(search_cells(qs.select("cell", "query", "qvec"), xs.select("cell", "item", "vec"), k, metric), k))
    if len(used) == 1:
        return own
    worst = own.filter(F.col("rank") == k).select("query", F.col("score").alias("kth"))
    first = qs.join(worst, "query", "left").withColumnRenamed("cell", "own")

    # Cells in the order of their pivots along the main direction, cut into groups.
    centred = points - points.mean(axis=0)
    along = np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")
    used, points = used[along], points[along]
    radius, counts = (np.array([cells[i][c] for i in along]) for c in ("r", "n"))
    group = np.unique((np.cumsum(counts) - counts) // GROUP, return_inverse=True)[1]
    starts = np.flatnonzero(np.diff(group, prepend=-1))

    def open_cells(asked: pd.DataFrame, at: np.ndarray) -> np.ndarray:
        """Which of the cells at `at` a query has to visit."""
        v, p = _matrix(asked["qvec"]), points[at]
        vv = (v * v).sum(axis=1)
        d = np.sqrt(np.maximum(vv[:, None] + (p * p).sum(axis=1)[None, :] - 2 * v @ p.T, 0.0))
        low = np.maximum(d - radius[None, at], (d - asked["to_pivot"].to_numpy()[:, None]) / 2)
        kth = asked["kth"].to_numpy(dtype=np.float64)
        if metric == "l2":
            limit = np.sqrt(np.maximum(-kth, 0.0))
        else:
            limit = np.sqrt(np.maximum(vv + item_sq - 2 * kth, 0.0))
        limit = np.where(np.isnan(kth), np.inf, limit)
        return (low <= limit[:, None] + SLACK) & (used[None, at] != asked["own"].to_numpy()[:, None])

    def remaining(batches):
        for pdf in batches:
            for i in range(0, len(pdf), SLICE):
                asked = pdf.iloc[i:i + SLICE]
                rows, cols = np.nonzero(np.logical_or.reduceat(open_cells(asked, np.arange(len(used))), starts, axis=1))
                out = asked.iloc[rows].reset_index(drop=True)
                out["cell"] = cols.astype("int32")
                yield out

    columns = ["query", "qvec", "own", "to_pivot", "kth"]
    more = first.select(*columns).mapInPandas(remaining, f"query {qt}, qvec array<double>, own int, to_pivot double, kth double, cell int")
    place = _cell_groups(xs.sparkSession, used, group)
    grouped = xs.join(F.broadcast(place), xs["cell"] == place["_cell"]).select(F.col("_group").alias("cell"), "item", "vec", F.col("_at").alias("part"))
    rest = search_cells(materialise(more), materialise(grouped), k, metric, GROUP, open_cells)
    return _best(own.select("query", "item", "score").unionByName(rest), k)


def _cell_groups(spark, cells: np.ndarray, group: np.ndarray) -> DataFrame:
    """One row for each cell: the group it belongs to and its place among the cells."""
    return spark.createDataFrame([(int(c), int(g), i) for i, (c, g) in enumerate(zip(cells, group, strict=True))], "_cell int, _group int, _at int")


def ivf_search(queries: DataFrame, items: DataFrame, k: int, metric: str, n_cells: int = 100, n_probe: int = 8, seed: int = 42) -> DataFrame:
    """Approximate top `k` from the `n_probe` nearest of `n_cells` k-means cells."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = items.select(array_to_vector("vec").alias("features"))
    centres = np.array(KMeans(k=n_cells, seed=seed, maxIter=10).fit(data).clusterCenters())  # n_cells vectors
    it, qt = dict(items.dtypes)["item"], dict(queries.dtypes)["query"]
    xs = materialise(items.mapInPandas(_nearest(centres, "vec", ["item", "vec"]), f"item {it}, vec array<double>, cell int, to_pivot double"))
    qs = queries.mapInPandas(_nearest(centres, "qvec", ["query", "qvec"], n_probe), f"query {qt}, qvec array<double>, cell int, to_pivot double")
    return _best(search_cells(materialise(qs.drop("to_pivot")), xs.drop("to_pivot"), k, metric), k)


def lsh_search(queries: DataFrame, items: DataFrame, k: int, metric: str, tables: int = 16, seed: int = 42, *, bits: int) -> DataFrame:
    """Approximate top `k` from random-hyperplane buckets; `bits` is to be chosen for the bucket size wanted, rows / 2^bits."""
    one = items.select(F.size("vec").alias("d")).first()
    planes = np.random.default_rng(seed).standard_normal((tables * bits, one["d"] if one else 1))

    def buckets(id_col: str, vec_col: str):
        def run(batches):
            powers = 1 << np.arange(bits)
            for pdf in (whole.iloc[i:i + CHUNK] for whole in batches for i in range(0, len(whole), CHUNK)):
                signs = (_matrix(pdf[vec_col]) @ planes.T > 0).reshape(len(pdf), tables, bits)
                cell = (signs * powers).sum(axis=2) + (np.arange(tables) << bits)[None, :]
                out = pdf[[id_col, vec_col]].iloc[np.repeat(np.arange(len(pdf)), tables)].reset_index(drop=True)
                out["cell"] = cell.ravel().astype("int32")
                yield out

        return run

    it, qt = dict(items.dtypes)["item"], dict(queries.dtypes)["query"]
    xs = materialise(items.mapInPandas(buckets("item", "vec"), f"item {it}, vec array<double>, cell int"))
    qs = materialise(queries.mapInPandas(buckets("query", "qvec"), f"query {qt}, qvec array<double>, cell int"))
    return _best(search_cells(qs, xs, k, metric), k)


def _classes(items: DataFrame) -> DataFrame:
    """(`item`, `class`, `place`) of items with equal vectors."""
    prints = materialise(items.select("item", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")))
    heads = prints.groupBy("h1", "h2").agg(F.min("item").alias("class"))
    return materialise(place_members(prints.join(heads, ["h1", "h2"]).select("item", "class")))


SEARCHES = {"exact": exact_search, "ivf": ivf_search, "lsh": lsh_search}


def _with_distance(df: DataFrame, metric: str) -> DataFrame:
    """Split the score into `similarity` and `distance`."""
    s = F.col("score")
    if metric == "l2":
        return df.withColumns({"distance": -s + 0.0, "similarity": F.round(1 / (1 - s), DIGITS)}).drop("score")
    away = F.sqrt(F.greatest(2 - 2 * s, F.lit(0.0))) if metric == "cosine" else -s
    return df.withColumns({"similarity": s, "distance": F.round(away, DIGITS)}).drop("score")


def nearest_neighbours(vectors: DataFrame, k: int = 10, *, id_col: str = "id", vec_col: str = "vector", metric: str = "cosine",
                       method: str = "exact", **options) -> DataFrame:
    """Best `k` other rows of every row: `query_id`, `neighbour_id`, `rank`, `distance`, `similarity`.

    metric: "cosine" (distance is the chord length), "ip", or "l2" (distance is
    squared). method: "exact", "ivf" or "lsh".
    """
    from opinara.operators.similarity import for_members

    if metric not in METRICS or method not in SEARCHES:
        raise ValueError(f"unknown metric or method: {metric!r}, {method!r}")
    items = materialise(_prepared(vectors, metric, "item", "vec", id_col, vec_col))
    members = _classes(items)
    heads = items.join(members.filter(F.col("place") == 0), "item", "left_semi")
    queries = heads.select(F.col("item").alias("query"), F.col("vec").alias("qvec"))
    ranked = SEARCHES[method](queries, heads, k + 1, metric, **options).select("query", F.col("item").alias("class"), "score")
    lists = expand_classes(ranked, members, k + 1)
    out = for_members(lists, members, k).withColumnRenamed("similarity", "score")
    return _with_distance(out, metric).select("query_id", "neighbour_id", "rank", "distance", "similarity")


def nearest_items(queries: DataFrame, vectors: DataFrame, k: int = 10, *, id_col: str = "id", vec_col: str = "vector",
                  metric: str = "cosine", method: str = "exact", **options) -> DataFrame:
    """Best `k` items for each row of another table, all in one job."""
    if metric not in METRICS or method not in SEARCHES:
        raise ValueError(f"unknown metric or method: {metric!r}, {method!r}")
    items = materialise(_prepared(vectors, metric, "item", "vec", id_col, vec_col))
    members = _classes(items)
    heads = items.join(members.filter(F.col("place") == 0), "item", "left_semi")
    asked = _prepared(queries, metric, "query", "qvec", id_col, vec_col)
    ranked = SEARCHES[method](asked, heads, k, metric, **options).select("query", F.col("item").alias("class"), "score")
    out = expand_classes(ranked, members, k).withColumnsRenamed({"query": "query_id", "item": "neighbour_id"})
    return _with_distance(out, metric).select("query_id", "neighbour_id", "rank", "distance", "similarity")
