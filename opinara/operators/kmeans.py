"""k-means for many models at once: all numbers of clusters and all starts share each pass over the vectors.

Seeding is k-means++: a centre is drawn with probability proportional to the squared distance from the centres so far. The draw is a race of
exponential clocks whose random numbers come from the row's id, so one pass draws one centre of every start, no row is
gathered, and the result does not depend on the partitions. A model of k clusters takes the first k centres of its start.

An iteration is one pass as well: a task multiplies its rows once with the centres of all models that still move and sends one sum for each
centre. Only these sums are shuffled; the driver holds the centres.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ITER, TOLERANCE = 300, 1e-4
SLICE = 4096  # rows that meet all centres at once


class Model(NamedTuple):
    k: int
    start: int
    centres: np.ndarray  # in lexicographic order
    inertia: float


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def row_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with their vectors, which are the last column."""
    for batch in batches:
        for i in range(0, len(batch), SLICE):
            part = batch.slice(i, SLICE)
            yield part, matrix(part.column(part.num_columns - 1))


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T), 0.0)


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _race(centres: list[np.ndarray], seed: int, step: int):
    """For each start the row of a task whose clock rings first; its rate is the squared distance to the nearest centre."""
    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[float, int, np.ndarray]] = {}
        for part, x in row_slices(batches):
            ticket = part.column(0).to_numpy().view(np.uint64)
            for start, found in enumerate(centres):
                rate = squared_distances(x, found).min(axis=1) if len(found) else np.ones(len(x))
                u = (_mix(ticket ^ _mix(np.uint64([(seed << 20) + (start << 10) + step]))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
                with np.errstate(divide="ignore"):
                    time = np.where(rate > 1e-12, -np.log1p(-u) / rate, np.inf)
                i = np.lexsort((ticket, time))[0]
                if np.isfinite(time[i]):
                    mine = (float(time[i]), int(ticket[i]), x[i])
                    best[start] = min(best.get(start, mine), mine, key=lambda m: m[:2])
        starts = sorted(best)
        yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array([best[s][0] for s in starts], pa.float64()), pa.array([best[s][2] for s in starts], pa.list_(pa.float64()))],
                                         names=["start", "time", "vector"])

    return race


def seed_centres(data: DataFrame, k: int, starts: int, seed: int) -> list[np.ndarray]:
    """Up to `k` centres for each start, fewer where there are fewer different rows. data: (ticket, vector)."""
    centres: list[np.ndarray] = [np.empty((0, 0))] * starts
    for step in range(k):
        drawn = data.mapInArrow(_race(centres, seed, step), "start int, time double, vector array<double>").groupBy("start").agg(F.min_by("vector", "time").alias("v")).collect()
        for start, v in drawn:
            centres[start] = np.vstack([centres[start], v]) if len(centres[start]) else np.array([v])
        if not drawn:
            break
    return centres


def grouped_sums(data: DataFrame, centres: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """For each model: rows, vector sums and sums of squares of its clusters, and the inertia, in one pass over `data` (.., vector)."""
    stacked = np.concatenate(centres)
    begin = np.cumsum([0, *map(len, centres)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(stacked)), np.zeros(stacked.shape)
        square, cost = np.zeros(len(stacked)), np.zeros(len(stacked))
        for _, x in row_slices(batches):
            d, norms = squared_distances(x, stacked), (x * x).sum(axis=1)
            for a, b in zip(begin[:-1], begin[1:], strict=True):
                at = d[:, a:b].argmin(axis=1)
                n[a:b] += np.bincount(at, minlength=b - a)
                square[a:b] += np.bincount(at, norms, b - a)
                cost[a:b] += np.bincount(at, d[np.arange(len(x)), a + at], b - a)
                hit = np.zeros((len(x), b - a))
                hit[np.arange(len(x)), at] = 1
                total[a:b] += hit.T @ x
        used = np.flatnonzero(n)
        sums = np.concatenate([np.stack([n, square, cost], 1), total], axis=1)[used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))], names=["at", "v"])

    rows = data.mapInArrow(run, "at int, v array<double>").groupBy("at").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    found = np.zeros((len(stacked), 3 + stacked.shape[1]))
    for at, v in rows:
        found[at] = v.toArray()
    return [(found[a:b, 0], found[a:b, 3:], found[a:b, 1], float(found[a:b, 2].sum())) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def fit_models(data: DataFrame, sizes: list[int], starts: int, seed: int, max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> list[Model]:
    """All models of `sizes` x `starts` over `data` (ticket, vector).

    A model moves until the squared steps of its centres add up to no more than `tolerance` times the mean variance of a coordinate.
    A cluster without rows keeps its centre. Without rows there is no model.
    """
    seeds = seed_centres(data, max(sizes), starts, seed)
    models = [(k, s, c[:k]) for s, c in enumerate(seeds) if len(c) for k in sizes]
    centres = [c for _, _, c in models]
    moving, limit = list(range(len(models))), None
    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for i, (n, total, square, _) in zip(moving, grouped_sums(data, [centres[i] for i in moving]), strict=True):
            if limit is None:
                mean = total.sum(axis=0) / n.sum()
                limit = tolerance * max(square.sum() / n.sum() - mean @ mean, 0.0) / len(mean)
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[i])
            if ((new - centres[i]) ** 2).sum() > limit:
                still.append(i)
            centres[i] = new
        moving = still
    centres = [c[np.lexsort(c.T[::-1])] for c in centres]
    return [Model(k, s, c, cost) for (k, s, _), c, (*_, cost) in zip(models, centres, grouped_sums(data, centres) if models else [], strict=True)]


def best_models(models: list[Model]) -> dict[int, Model]:
    """For each number of clusters the model of the least inertia, the earlier start of equal ones."""
    return {k: min((m for m in models if m.k == k), key=lambda m: (round(m.inertia, 9), m.start)) for k in sorted({m.k for m in models})}


def assign(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """`rows` (.., vector last) with `cluster`, the nearest centre, ties to the lower number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in row_slices(batches):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(squared_distances(x, centres).argmin(axis=1), pa.int32())], names=[*part.schema.names, "cluster"])

    return rows.mapInArrow(run, rows.select("*").schema.add("cluster", "integer"))


def mean_silhouettes(data: DataFrame, labels: Callable[[np.ndarray], list[np.ndarray]], sums: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[float]:
    """Mean silhouette on squared distances of each model in one pass; `labels` gives every model's clusters of a slice, `sums` their rows, vector sums and sums of squares.

    The mean squared distance from x to a cluster is |x|^2 + sq / n - 2 x.total / n. A row alone in its cluster counts 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, rows = np.zeros(len(sums)), 0
        for _, x in row_slices(batches):
            norms, at, rows = (x * x).sum(axis=1), np.arange(len(x)), rows + len(x)
            for m, (own, (n, total, square)) in enumerate(zip(labels(x), sums, strict=True)):
                used = n > 0
                mean = np.full((len(x), len(n)), np.inf)
                mean[:, used] = np.maximum(norms[:, None] + (square / np.maximum(n, 1))[used] - 2 * (x @ total[used].T) / n[used], 0.0)
                a = mean[at, own] * n[own] / np.maximum(n[own] - 1, 1)
                mean[at, own] = np.inf
                b = mean.min(axis=1)
                most = np.maximum(a, b)
                fine = (n[own] > 1) & (most > 0) & np.isfinite(most)
                score[m] += np.where(fine, (np.where(fine, b, 0) - a) / np.where(fine, most, 1), 0.0).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(score), pa.array(np.full(len(sums), rows))], names=["m", "s", "n"])

    found = {m: s / max(n, 1) for m, s, n in data.mapInArrow(run, "m int, s double, n bigint").groupBy("m").agg(F.sum("s"), F.sum("n")).collect()}
    return [found.get(m, 0.0) if (n > 0).sum() > 1 else -1.0 for m, (n, _, _) in enumerate(sums)]
