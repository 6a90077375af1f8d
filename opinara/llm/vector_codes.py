"""Product codes of vectors by an active-entry Lloyd iteration over integer components.

A component x becomes the integer floor(scale * x); a vector is cut into equal consecutive parts, and each
part position has a codebook of its own. A round assigns every part to its nearest entry and
replaces each entry by the componentwise floor of the mean of its parts. A row keeps its assigned
entries with their exact squared distances, so that the next round

* compares a part whose entry stayed where it was only with the entries that moved: the others lost
  against a distance that still holds, and ties still go to the lower index;
* rescans the whole codebook for a part whose entry moved.

A round is one pass without a shuffle of rows: it writes the rows with their new state and, for each
task, the sums of its parts by entry. Only these sums are shuffled, and one row for each entry reaches the driver.
Entries fit in `parts * size` short vectors, so codebooks are broadcast within a fixed bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.session import intermediate_path

EXACT = 1 << 20  # below this magnitude sums of products of a part are exact in double precision
SLICE = 8192  # rows that are compared at once
ROW = "id bigint, label {label}, vec binary, codes binary, dists binary"
SUMS = "part int, entry int, n bigint, sums array<bigint>"


def integer_vectors(vectors: DataFrame, parts: int, scale: int, vec_id: str, embedding: str, label: str | None) -> tuple[DataFrame, int, int]:
    """Rows (id, label, vec) that are kept, with integer components, their number filled up with zeros to a multiple of `parts`; least and largest component."""
    named = F.col(f"`{label}`") if label else F.lit(None).cast("int")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), named.alias("label"), F.col(f"`{embedding}`").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec").isNotNull() & (F.size("vec") > 0)).filter(F.coalesce(finite, F.lit(False)))
    whole = lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")
    common = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows"), whole(F.min(F.array_min("vec"))), whole(F.max(F.array_max("vec"))))
    dims, _, low, high = common.orderBy(F.desc("rows"), F.desc("n")).first() or (0, 0, 0, 0)
    fill = F.array_repeat(F.lit(0).cast("long"), -dims % parts)
    return rows.filter(F.size("vec") == F.lit(dims)).select("id", "label", F.concat(F.transform("vec", whole), fill).alias("vec")), low, high


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows x entries, of integer vectors."""
    if len(x) and -EXACT <= min(x.min(), entries.min()) and max(x.max(), entries.max()) <= EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        apart = x[:, i, None] - entries[None, :, i]
        out += apart * apart
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry, ties to the lower index."""
    d = distances(x, entries)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(d)), at]


def advance(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Assignments after the entries in `moved` (a mask) have changed; `at` and `dist` held before."""
    at, dist = at.copy(), dist.copy()
    stale = moved[at]
    if stale.any():
        at[stale], dist[stale] = nearest(x[stale], entries)
    index = np.flatnonzero(moved)
    held = np.flatnonzero(~stale)
    if len(index) and len(held):
        near, d = nearest(x[held], entries[index])
        near = index[near]
        better = (d < dist[held]) | ((d == dist[held]) & (near < at[held]))
        at[held[better]], dist[held[better]] = near[better], d[better]
    return at, dist


def _fixed(column: pa.Array, kind, width: int) -> np.ndarray:
    """A binary column of rows of one width as a matrix."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty((0, width), kind)
    first = np.frombuffer(offsets, np.int64)[column.offset]
    return np.frombuffer(data, kind, len(column) * width, int(first)).reshape(len(column), width)


def _binary(matrix: np.ndarray) -> pa.Array:
    n, width = len(matrix), matrix.shape[1] * matrix.itemsize if len(matrix) else 0
    offsets = (np.arange(n + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def _assign(parts: int, width: int, kind, index_kind, books: np.ndarray, moved: np.ndarray | None):
    """Rows with their new assignment, then the task's sums for each entry; `moved` None: nothing is known yet."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = books.shape[1]
        sums, counts = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64)
        blank_sums = lambda n: [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
        names = ["id", "label", "vec", "codes", "dists", "part", "entry", "n", "sums"]
        label_type = None
        for whole in batches:
            label_type = whole.column(1).type
            for start in range(0, len(whole), SLICE):
                batch = whole.slice(start, SLICE)
                if batch.schema.field(2).type in (pa.binary(), pa.large_binary()):
                    x = _fixed(batch.column(2), kind, parts * width)
                else:
                    x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).astype(kind)
                codes, dists = np.empty((len(x), parts), index_kind), np.empty((len(x), parts), np.int64)
                if moved is not None:
                    old, held = _fixed(batch.column(3), index_kind, parts), _fixed(batch.column(4), np.int64, parts)
                for p in range(parts):
                    mine = x[:, p * width:(p + 1) * width].astype(np.int64)
                    at, d = nearest(mine, books[p]) if moved is None else advance(mine, books[p], moved[p], old[:, p].astype(np.int64), held[:, p])
                    codes[:, p], dists[:, p] = at, d
                    order = np.argsort(at, kind="stable")
                    ends = np.searchsorted(at[order], np.arange(size + 1))
                    used = np.flatnonzero(ends[1:] > ends[:-1])
                    sums[p, used] += np.add.reduceat(mine[order], ends[used], axis=0)
                    counts[p] += np.diff(ends)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _binary(x), _binary(codes), _binary(dists), *blank_sums(len(x))], names=names)
        at = np.argwhere(counts)
        if len(at):
            kept = [pa.nulls(len(at), t) for t in (pa.int64(), label_type, pa.binary(), pa.binary(), pa.binary())]
            p, e = at[:, 0], at[:, 1]
            total = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept, *total], names=names)

    return assign


def _unpack(parts: int, index_kind, digits: int):
    """(id, label, code, error) of assigned rows."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = np.array([format(i, f"0{digits}x") for i in range(16 ** digits)])
        for batch in batches:
            codes, dists = _fixed(batch.column(2), index_kind, parts), _fixed(batch.column(3), np.int64, parts)
            code = pa.array([] if not len(codes) else ["".join(r) for r in text[codes].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code, pa.array(dists.sum(axis=1))], names=["id", "label", "code", "error"])

    return unpack


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 4, size: int = 256, rounds: int = 4, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding",
             label: str | None = "label") -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): vec_id, code, error and label_error of every kept row; codebooks as parts x entries x components.

    A codebook starts as that part of the `size` smallest vec_ids (all rows, if fewer), ascending; it keeps an entry that no part
    was assigned to. After `rounds` rounds all parts are assigned once more. `code` is the index of each part in hexadecimal digits,
    `error` the sum of the squared distances, `label_error` the sum of `error` over the rows of an equal label, null labels together.

    Null vectors, empty ones and vectors with null or non-finite components are dropped, as are vectors of another length than the most
    common one. A length that is no multiple of `parts` is filled up with zeros. Repeated rows all count; a null vec_id
    comes last, rows of one vec_id are ordered by their components. An empty table gives an empty result and no codebooks. Other columns
    are ignored. Arithmetic is that of 64-bit integers: exact for components below 2^26 after scaling, modulo 2^64 beyond.
    """
    spark = vectors.sparkSession
    rows, low, high = integer_vectors(vectors, parts, scale, vec_id, embedding, label)
    kind_of_label = rows.schema["label"].dataType.simpleString()
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").select("vec").limit(size).collect()
    if not first:
        none = spark.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint")
        return none, np.empty((parts, 0, 0), np.int64)
    books = np.array([r["vec"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    width = books.shape[2]
    kind = next((k for k in (np.int16, np.int32) if np.iinfo(k).min <= low and high <= np.iinfo(k).max), np.int64)
    index_kind, digits = (np.uint8, 2) if size <= 256 else (np.uint16, 4)
    row = ROW.format(label=kind_of_label)
    moved = None
    for step in range(rounds + 1):
        path = intermediate_path(spark, "codes")
        state = rows.mapInArrow(_assign(parts, width, kind, index_kind, books, moved), f"{row}, {SUMS}")
        state.withColumn("total", F.col("n").isNotNull()).write.partitionBy("total").parquet(path)
        written = spark.read.schema(f"{row}, {SUMS}, total boolean").parquet(path)
        rows = written.filter("not total").select("id", "label", "vec", "codes", "dists")
        if step < rounds:
            sums = written.filter("total").groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
            new = books.copy()
            for part, entry, n, *total in sums.collect():
                new[part, entry] = np.array(total, np.int64) // n
            moved, books = (new != books).any(axis=2), new
    coded = rows.select("id", "label", "codes", "dists").mapInArrow(_unpack(parts, index_kind, digits), f"id bigint, label {kind_of_label}, code string, error bigint")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(F.col("id").alias("vec_id"), "code", "error", "label_error")
    return out, books
