"""Density clustering with a grid, and connected components."""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.vectors import as_doubles
from opinara.operators.cluster import _assignment, standardise
from opinara.operators.toprows import with_position
from opinara.session import materialise, spread, width

CHUNK = 2048
SAMPLE = 16_384  # cells by which the others are parted


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(`node`, `component`): the smallest node of each component.

    Every round takes the smallest label among the neighbours and then the label
    of that label, so long chains shorten quickly. Rounds are written to the
    shared folder; they end when nothing changes.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialise(nodes.select("node", F.col("node").alias("label")))
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(seen, labels["node"] == seen["a"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        low = materialise(low)
        up = low.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        new = materialise(low.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("higher", "label")).alias("label")))
        if new.filter(F.col("label") != F.col("old")).isEmpty():
            return new.select("node", F.col("label").alias("component"))
        labels = new.select("node", "label")


UNROLLED = 16
GRID_DIMS = 3  # 27 surrounding squares; each dimension more would triple them


def _squared(x: str, y: str, dims: int, part=lambda a, b: (a - b) * (a - b)):
    """Sum of `part` over the coordinates; written out for few of them, so that it compiles."""
    if dims <= UNROLLED:
        return reduce(lambda a, b: a + b, [part(F.col(x)[i], F.col(y)[i]) for i in range(dims)])
    return F.aggregate(F.zip_with(x, y, part), F.lit(0.0), lambda s, v: s + v)


def _apart(x, y, side):
    away = F.greatest(F.abs(x - y) - 1.0, F.lit(0.0)) * F.lit(side)
    return away * away


def _grid_pairs(cells: DataFrame, side: float, eps: float, dims: int) -> DataFrame:
    """Ordered pairs of occupied cells whose boxes come within `eps`, each cell with itself included; up to 3 dimensions."""
    spot = [F.floor(F.col("at")[i] * F.lit(side / (2 * eps))) for i in range(dims)]
    steps = F.array(*[F.array(*[F.lit(o).cast("long") for o in off]) for off in product((-1, 0, 1), repeat=dims)])
    a = spread(cells).select(F.col("cell").alias("a"), F.col("at").alias("a_at"), F.array(*spot).alias("s"), F.explode(steps).alias("o"))
    a = a.select("a", "a_at", F.array(*[F.col("s")[i] + F.col("o")[i] for i in range(dims)]).alias("spot"))
    b = cells.select(F.col("cell").alias("b"), F.col("at").alias("b_at"), F.array(*spot).alias("spot"))
    gap = _squared("a_at", "b_at", dims, lambda x, y: _apart(x, y, side))
    return a.join(b, "spot").filter(gap <= F.lit(eps * eps * (1 + 1e-9))).select("a", "b")


def _parts(sample: np.ndarray, margin: int, most: float) -> tuple | int:
    """Nested halves (`dimension`, `first place of the upper half`, `lower`, `upper`) of the sampled cells; a leaf is its number.

    A half is cut where the fewest cells lie within `margin` of the cut, until it holds at most `most` cells or is too thin.
    """
    numbers = iter(range(len(sample) + 1))

    def halves(at):
        cuts = []
        for d in range(at.shape[1]) if len(at) > most else ():
            v = np.floor(np.median(at[:, d])) + 1
            upper = (at[:, d] >= v).sum()
            if 4 * upper >= len(at) and at[:, d].max() - at[:, d].min() > 2 * margin:
                cuts.append(((np.abs(at[:, d] - v) <= margin).sum(), d, v))
        if not cuts:
            return next(numbers)
        _, d, v = min(cuts)
        up = at[:, d] >= v
        return d, float(v), halves(at[~up]), halves(at[up])

    return halves(sample)


def _box_pairs(u: tuple[np.ndarray, np.ndarray], v: tuple[np.ndarray, np.ndarray], eps: float):
    """Positions of the boxes (lower, upper corners) `u` and `v` that come within `eps`; halves of `u` meet what lies near them."""
    limit, found, todo = eps * eps * (1 + 1e-9), [], [(np.arange(len(u[0])), np.arange(len(v[0])))]
    reach = eps * (1 + 1e-9)
    while todo:
        i, j = todo.pop()
        if len(i) > 32 and len(j) > 32:
            middle = np.nan_to_num(u[0][i])
            d = np.ptp(middle, axis=0).argmax()
            up = middle[:, d] > np.median(middle[:, d])
            if up.any():
                for half in (i[~up], i[up]):
                    lo, hi = np.fmin.reduce(u[0][half, d]) - reach, np.fmax.reduce(u[1][half, d]) + reach
                    todo.append((half, j[~((v[0][j, d] > hi) | (v[1][j, d] < lo))]))
                continue
        for a in range(0, len(i), 32):
            part = i[a:a + 32]
            gap = np.zeros((len(part), len(j)))
            for d in range(u[0].shape[1]):
                gap += np.fmax(np.fmax(v[0][None, j, d] - u[1][part, d, None], u[0][part, d, None] - v[1][None, j, d]), 0) ** 2
            x, y = np.nonzero(gap <= limit)
            found.append((part[x], j[y]))
    return [np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*found, strict=True)] or [np.empty(0, np.int64)] * 2


def _pivot_pairs(cells: DataFrame, side: float, eps: float, dims: int, pivots: int) -> DataFrame:
    """As `_grid_pairs`, in any number of dimensions.

    A sample of the cells is halved, always where the cut has the fewest cells beside it, into at least `pivots`
    parts and about one for each `CHUNK` cells. A cell belongs to one part and is shown to all parts within `eps`. What meets
    there is cut into chunks; in a task the halving goes on. Cells with corners `lo` and `hi` of what they hold meet by these.
    """
    margin = int(np.floor(eps / side * (1 + 1e-6))) + 1
    parts = max(pivots, -(-cells.count() // CHUNK))
    chosen = cells.orderBy(F.xxhash64("cell"), "cell").limit(max(32 * parts, SAMPLE)).select("at").collect()  # 32 rows for each part
    sample = np.array([r["at"] for r in chosen]).reshape(-1, dims)
    tree, kind = _parts(sample, margin, len(sample) / parts), dict(cells.dtypes)["cell"]
    if "lo" not in cells.columns:
        corner = lambda more: F.transform("at", lambda x: (x + more) * F.lit(side))
        cells = cells.select("cell", "at", corner(0).alias("lo"), corner(1).alias("hi"))

    def place(batches):
        for b in batches:
            if not len(b):
                continue
            at = b.column("at").flatten().to_numpy().reshape(len(b), dims)
            todo, found = [(tree, np.arange(len(b)), np.ones(len(b), bool))], []
            while todo:
                node, rows, own = todo.pop()
                if isinstance(node, int):
                    found.append((np.full(len(rows), node), rows, own))
                    continue
                d, v, lower, upper = node
                x = at[rows, d]
                low, up = x < v + margin, x >= v - margin
                todo += [(lower, rows[low], own[low] & (x[low] < v)), (upper, rows[up], own[up] & (x[up] >= v))]
            part, rows, own = (np.concatenate(c) for c in zip(*found, strict=True))
            shown = b.select(["cell", "lo", "hi"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*shown.columns, pa.array(part.astype(np.int32)), pa.array(own)], names=["cell", "lo", "hi", "part", "own"])

    placed = materialise(spread(cells.select("cell", "at", "lo", "hi")).mapInArrow(place, f"cell {kind}, lo array<double>, hi array<double>, part int, own boolean"))
    asks, shown = placed.filter("own").drop("own"), placed.drop("own")
    number = lambda df, name: df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / (4 * CHUNK)).cast("int").alias(name))
    sizes = materialise(number(asks, "n_a").join(number(shown, "n_b"), "part"))
    chunk = lambda n: F.pmod(F.xxhash64("cell"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asks.join(sizes, "part").select("part", chunk("n_a").alias("ca"), every("n_b").alias("cb"), "cell", "lo", "hi")
    right = shown.join(sizes, "part").select("part", every("n_a").alias("ca"), chunk("n_b").alias("cb"), "cell", "lo", "hi")
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        corners = lambda t, r: tuple(t[f"{r}{c}"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), dims) for c in ("lo", "hi"))
        i, j = _box_pairs(corners(x, ""), corners(y, "r_"), eps) if len(x) and len(y) else ([], [])
        return pa.table({"a": x["cell"].take(pa.array(i, pa.int64())), "b": y["r_cell"].take(pa.array(j, pa.int64()))})

    keys = ["part", "ca", "cb"]
    return left.groupBy(keys).cogroup(right.groupBy([f"r_{c}" for c in keys])).applyInArrow(meet, f"a {kind}, b {kind}")


def _linked_full(pairs: DataFrame, cells: DataFrame, points: DataFrame, eps: float, dims: int) -> DataFrame:
    """Links that join full cells into the same components as all their pairs of points within `eps` do.

    One point of each cell, the one nearest its middle, speaks for it at first. Only pairs of cells in different
    components of these links are searched point by point, and none whose cells hold a single point each.
    """
    of = lambda c: cells.select(F.col("cell").alias(c), F.col("n").alias(f"n_{c}"), F.col("middle").alias(f"m_{c}"))
    met = pairs.join(of("a"), "a").join(of("b"), "b")
    met = materialise(met.select("a", "b", (_squared("m_a", "m_b", dims) <= F.lit(eps * eps)).alias("sure"), (F.col("n_a") + F.col("n_b") > 2).alias("more")))
    found = connected_components(cells.filter("full").select(F.col("cell").alias("node")), met.filter("sure"))
    in_a, in_b = (found.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}")) for c in "ab")
    left = met.filter("more and not sure").join(in_a, "a").join(in_b, "b").filter("c_a <> c_b").select("a", "b")
    star = found.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
    return star.unionByName(_linked_dense(left, points, eps))


def _linked_dense(pairs: DataFrame, points: DataFrame, eps: float) -> DataFrame:
    """Pairs of full cells that hold two points within `eps`, searched chunk by chunk."""
    sizes = materialise(points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("n")))
    pairs = materialise(pairs)
    if pairs.isEmpty():
        return pairs
    # Most pairs already meet among one chunk of each; only the others are searched whole.
    once = materialise(_meeting(pairs, points, sizes, eps, first=True))
    large = sizes.filter("n > 1").select("cell")
    left = pairs.join(once, ["a", "b"], "left_anti")
    left = left.join(large.withColumnRenamed("cell", "a"), "a", "left_semi").unionByName(left.join(large.withColumnRenamed("cell", "b"), "b", "left_semi")).distinct()
    return once.unionByName(_meeting(left, points, sizes, eps, first=False))


def _meeting(pairs: DataFrame, points: DataFrame, sizes: DataFrame, eps: float, first: bool) -> DataFrame:
    """Those of `pairs` with two points within `eps`; with `first` only chunk 0 of each cell is looked at."""
    p = pairs.join(sizes.withColumnsRenamed({"cell": "a", "n": "n_a"}), "a").join(sizes.withColumnsRenamed({"cell": "b", "n": "n_b"}), "b")
    chunked = p.withColumn("ca", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1))).withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)))
    if first:
        chunked = p.withColumns({"ca": F.lit(0), "cb": F.lit(0)})
    part = points.join(sizes, "cell").select("cell", F.pmod(F.xxhash64("pid"), F.col("n")).cast("int").alias("c"), "vec")
    left = chunked.join(part.withColumnsRenamed({"cell": "a", "c": "ca"}), ["a", "ca"]).select("a", "b", "ca", "cb", "vec")
    right = chunked.join(part.withColumnsRenamed({"cell": "b", "c": "cb"}), ["b", "cb"])
    keys = ["a", "b", "ca", "cb"]
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in keys], F.col("vec").alias("r_vec"))

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        u, v = np.array(x["vec"].tolist()), np.array(y["r_vec"].tolist())
        hit = False
        for i in range(0, len(u), 256):
            d = ((u[i:i + 256, None, :] - v[None, :, :]) ** 2).sum(axis=2)
            if (d <= eps * eps).any():
                hit = True
                break
        return x[["a", "b"]].head(1) if hit else x[["a", "b"]].head(0)

    kind = dict(pairs.dtypes)["a"]
    return left.groupBy(*keys).cogroup(right.groupBy(*[f"r_{c}" for c in keys])).applyInPandas(meet, f"a {kind}, b {kind}").distinct()


def _moving(base: DataFrame, dims: int) -> tuple[DataFrame, int]:
    """Without the coordinates that are the same in every row, which no distance depends on; one is kept."""
    at = lambda i: F.col("vec")[i]
    seen = base.agg(F.count(F.lit(1)).alias("n"), *[F.struct(F.min(at(i)), F.max(at(i)), F.count(at(i))).alias(f"c{i}") for i in range(dims)]).first()
    kept = [i for i in range(dims) if seen[f"c{i}"][0] != seen[f"c{i}"][1] or seen[f"c{i}"][2] < seen["n"]] or [0]
    return (base, dims) if len(kept) == dims else (base.withColumn("vec", F.array(*[at(i) for i in kept])), len(kept))


def dbscan(features: DataFrame, eps: float = 0.5, min_samples: int = 5, scale: bool = True, pivots: int = 64) -> DataFrame:
    """(`id`, `cluster`, `feature_1`, `feature_2`), noise is -1.

    A point with `min_samples` rows within `eps`, itself included, is core;
    core points within `eps` share a cluster; a border point joins the cluster
    with the lowest number. Clusters are numbered by their lowest core id.

    Equal vectors collapse to one weighted point. The grid's cells are so small
    that a cell's points lie within `eps` of each other: a cell holding
    `min_samples` rows is core as a whole and its points are never compared with
    one another. Only points of the thinner cells, fewer than `min_samples` per
    cell, are compared with their surroundings. Full cells are linked through one point each, and searched whole only where
    that leaves them in different components. Coordinates that never change are left out. Up to three dimensions cells find each other
    by the grid, beyond in parts of the space, `pivots` of them at least; the labels are the same.
    """
    base = standardise(features) if scale else features.withColumn("vector", as_doubles("vector"))
    base = materialise(base.select("id", F.col("vector").alias("vec")))
    first = base.first()
    if first is None:
        return _assignment(base.select("id", F.lit(-1).cast("long").alias("cluster")), features)
    base, dims = _moving(base, len(first["vec"]))
    side = eps / sqrt(dims) * (1 - 1e-9)

    prints = base.select("id", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    heads = prints.groupBy("h1", "h2").agg(F.min("id").alias("pid"), F.count(F.lit(1)).alias("w"))
    members = materialise(prints.join(heads, ["h1", "h2"]).select("id", "pid"))
    at = F.transform("vec", lambda x: F.floor(x / F.lit(side)).cast("double"))
    named = materialise(
        base.withColumnRenamed("id", "pid").join(heads.select("pid", "w"), "pid")
        .withColumn("at", at).withColumn("name", F.array_join(F.col("at").cast("array<bigint>").cast("array<string>"), ","))
    )
    off = F.aggregate(F.zip_with("vec", "at", lambda x, a: (x / F.lit(side) - a - 0.5) * (x / F.lit(side) - a - 0.5)), F.lit(0.0), lambda s, v: s + v)
    corner = lambda f: F.array(*[f(F.col("vec")[i]) for i in range(dims)])
    cells = materialise(named.groupBy("name").agg(
        F.first("at").alias("at"), (F.sum("w") >= min_samples).alias("full"), F.count(F.lit(1)).alias("n"), F.min_by("vec", off).alias("middle"),
        corner(F.min).alias("lo"), corner(F.max).alias("hi")).withColumn("cell", F.monotonically_increasing_id()))
    points = materialise(named.join(cells.select("name", "cell", "full"), "name").select("pid", "vec", "w", "cell", "full"))
    near = materialise(_grid_pairs(cells, side, eps, dims) if dims <= GRID_DIMS else _pivot_pairs(cells, side, eps, dims, pivots))
    in_full, thin = points.filter("full"), points.filter("not full")

    # Neighbours of the thin cells' points: single ones in thin cells, the rows of a full cell as one number.
    around = thin.select(F.col("pid").alias("p"), F.col("vec").alias("pv"), F.col("cell").alias("a")).join(near, "a")
    around = around.repartition(width(near), "p")
    single = F.when(F.col("full"), None).otherwise(F.col("pid")).alias("q")
    close = materialise(
        around.join(points.select(single, F.col("vec").alias("qv"), F.col("w").alias("qw"), F.col("cell").alias("b"), F.col("full").alias("b_full")), "b")
        .filter(_squared("pv", "qv", dims) <= F.lit(eps * eps)).groupBy("p", "a", "b", "b_full", "q").agg(F.sum("qw").alias("qw"))
    )
    thin_core = materialise(close.groupBy(F.col("p").alias("pid")).agg(F.sum("qw").alias("n")).filter(F.col("n") >= min_samples).select("pid"))
    core = materialise(in_full.select("pid", "cell").unionByName(thin.join(thin_core, "pid", "left_semi").select("pid", "cell")))

    # Links between cells that hold core points.
    near_core = close.filter("b_full").unionByName(close.filter("not b_full").join(thin_core.select(F.col("pid").alias("q")), "q", "left_semi"))
    links = near_core.join(thin_core.select(F.col("pid").alias("p")), "p", "left_semi").filter(F.col("a") != F.col("b")).select("a", "b")
    full = cells.filter("full").select("cell")
    full_pairs = (
        near.filter(F.col("a") < F.col("b")).join(full.withColumnRenamed("cell", "a"), "a", "left_semi")
        .join(full.withColumnRenamed("cell", "b"), "b", "left_semi").select("a", "b")
    )
    links = links.unionByName(_linked_full(full_pairs, cells, in_full.select("cell", "pid", "vec"), eps, dims)).distinct()
    first_core = core.groupBy("cell").agg(F.min("pid").alias("node"))
    node_of = lambda c: first_core.select(F.col("cell").alias(c), F.col("node").alias(f"n_{c}"))
    edges = links.join(node_of("a"), "a").join(node_of("b"), "b").select(F.col("n_a").alias("a"), F.col("n_b").alias("b"))
    component = connected_components(first_core.select("node"), edges)
    cell_cluster = materialise(first_core.join(component, "node").select("cell", "component"))

    core_label = core.join(cell_cluster, "cell").select("pid", "component")
    border = (
        near_core.join(thin_core.select(F.col("pid").alias("p")), "p", "left_anti")
        .join(cell_cluster.withColumnRenamed("cell", "b"), "b").groupBy(F.col("p").alias("pid")).agg(F.min("component").alias("component"))
    )
    numbers = with_position(cell_cluster.select("component").distinct(), ["component"], "cluster")
    labels = core_label.unionByName(border).join(numbers, "component").select("pid", "cluster")
    out = members.join(labels, "pid", "left").select("id", F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    return _assignment(out, features)
