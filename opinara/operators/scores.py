"""Top items of every query by a weighted sum over shared dimensions.

`score(query, item) = sum over dims of query weight * item weight`, all weights
positive. This one shape serves neighbour ratings, item similarities and term
profiles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from opinara.functions.scalars import fixed
from opinara.operators.toprows import top_n_per_key
from opinara.session import discard, materialise

HOT_LIMIT = 10_000
DIGITS = 9
BLOCK_ENTRIES = 4_000_000  # list entries that a block of queries may need
BLOCK_ROWS = 2_000_000  # query weights of a block
BLOCK_QUERIES = 50_000  # queries of a block that the items pass by
BLOCK_BEST = 1_500_000  # items that these may keep
TILE_ENTRIES = 8_000_000  # weights of the items of a tile, which pass by
PART = 1 << 20  # weights that are packed at once
PACK = 1 << 16  # weights that travel as one row
KEPT = 1 << 20  # items that wait at most before only the best are kept
SLICE = 1 << 20  # products that are summed at once
SLACK = 1e-9  # relative, for bounds
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    return top_n_per_key(scores, ["query"], [F.desc("score"), F.asc("item")], k)


def _summed(products: DataFrame, exclude: DataFrame | None) -> DataFrame:
    """Sum products per (query, item); excluded pairs leave in the same shuffle."""
    rows = products.select("query", "item", "s", "norm", F.lit(0).alias("x"))
    if exclude is not None:
        rows = rows.unionByName(exclude.select("query", "item", F.lit(0.0).alias("s"), F.lit(0.0).alias("norm"), F.lit(1).alias("x")))
    total = rows.groupBy("query", "item").agg(F.sum("s").alias("score"), F.max("norm").alias("norm"), F.max("x").alias("x"))
    return total.filter((F.col("x") == 0) & (F.col("score") > 0)).drop("x")


def _products(queries: DataFrame, items: DataFrame) -> DataFrame:
    return queries.join(items, "dim").select("query", "item", (F.col("qw") * F.col("iw")).alias("s"), "norm")


def _heads(hot_items: DataFrame, sizes: DataFrame, depth: int) -> DataFrame:
    """The `depth` items of each dimension that weigh most by `own`: with `place` and `n_items`.

    They are picked from salted parts of a dimension first, so that no task sorts a whole one.
    """
    part = F.pmod(F.xxhash64("item"), F.ceil(F.col("n_items") / F.lit(max(16 * depth, 100_000))))
    salted = top_n_per_key(hot_items.join(sizes, "dim").withColumn("_part", part), ["dim", "_part"], [F.desc("own"), F.asc("item")], depth, "place")
    return top_n_per_key(salted.drop("_part", "place"), ["dim"], [F.desc("own"), F.asc("item")], depth, "place")


def _lists(rows: DataFrame, *more: Column) -> DataFrame:
    """One row for each dimension: its items and weights as arrays."""
    packed = rows.groupBy("dim").agg(F.collect_list(F.struct("item", "iw", "norm")).alias("l"), *more)
    return packed.select("dim", F.col("l.item").alias("items"), F.col("l.iw").alias("weights"), F.col("l.norm").alias("norms"), *(c for c in packed.columns if c not in ("dim", "l")))


def _key(score: Column, norm: Column, digits: int | None) -> Column:
    """What scores are ranked by."""
    return F.round(score, DIGITS) / F.round(norm, DIGITS) if digits is None else fixed(score, digits)


def _score_block(k: int, digits: int | None, norm: float):
    """The task of a block: sums of each query's lists, its best items or, where lists are cut, all that may be among the best."""
    unit = float(10 ** (digits or DIGITS))
    tied = 1e-13 if digits is None else 0.0  # quotients carry rounding errors

    def rounded(x):
        return x if digits is None else np.floor(x * unit + 0.5) / unit

    def best(codes: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Positions of the first `k` by key, then by item; codes ascend with the items."""
        if len(r) > k:
            kth = np.partition(r, len(r) - k)[len(r) - k]
            above, level = np.flatnonzero(r > kth), np.flatnonzero(r == kth)
            at = np.concatenate([above, level[:k - len(above)]])
        else:
            at = np.arange(len(r))
        return at[np.lexsort((codes[at], -r[at]))]

    def passing(asked: _Asked, piece: dict | None) -> None:
        """Add up the products of a piece's items and the block's queries in slices of whole items; what can be among the best is kept."""
        if piece is None:  # nothing is left to pass
            return
        dims, n, code, weights = _unpacked(piece)
        items, m = piece["item"], len(asked.names)
        norms = None if piece["norm"] is None else np.frombuffer(piece["norm"])
        where = np.minimum(np.searchsorted(asked.dims, dims), len(asked.dims) - 1)
        lengths = np.where(asked.dims[where] == dims, asked.starts[where + 1] - asked.starts[where], 0)
        begin, lengths = np.repeat(asked.starts[where], n), np.repeat(lengths, n)
        use = np.flatnonzero(lengths)
        order = use[np.argsort(code[use], kind="stable")]
        code, weights, begin, lengths = code[order].astype(np.int64), weights[order], begin[order], lengths[order]
        ends = np.cumsum(lengths)
        starts = np.append(np.flatnonzero(np.diff(code, prepend=-1)), len(code))  # of items
        before = np.append(0, ends)[starts]
        gone = np.sort(np.searchsorted(items, asked.here[1]) * m + asked.here[0])

        def sums(i: int, j: int):
            """(queries, items, sums) of the entries from `i` to `j`; a single item adds up slice by slice."""
            item, total, dense = code[i:j], int(ends[j - 1] - (ends[i - 1] if i else 0)), None
            first, last = int(item[0]), int(item[-1]) + 1
            whole = first + 1 == last or total * 4 > (last - first) * m
            while i < j:
                e = j if total <= SLICE else min(j, max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE, "right"))))
                c = lengths[i:e]
                at = np.arange(c.sum()) + np.repeat(begin[i:e] - (np.cumsum(c) - c), c)
                q, value, of = asked.code[at], asked.w[at] * np.repeat(weights[i:e], c), np.repeat(code[i:e] - first, c)
                if not whole:
                    break
                part = np.bincount(of * m + q, value, (last - first) * m)
                dense = part if dense is None else dense + part
                i = e
            if whole:
                hit = np.flatnonzero(dense > 0)
                return (hit % m), hit // m + first, dense[hit]
            order = np.argsort(q, kind="stable")  # items ascend already
            q, of, value = q[order], of[order], value[order]
            new = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (of[1:] != of[:-1])]))
            return q[new].astype(np.int64), of[new] + first, np.add.reduceat(value, new)

        s = 0
        while s < len(starts) - 1:
            e = max(s + 1, int(np.searchsorted(before, before[s] + SLICE, "right")) - 1)
            q, of, score = sums(starts[s], starts[e])
            s = e
            may = np.flatnonzero((score > 0) & (asked.key(score, None if norms is None else norms[of]) >= asked.kth[q]))
            if len(gone):
                pair = of[may] * m + q[may]
                at = np.minimum(np.searchsorted(gone, pair), len(gone) - 1)
                may = may[gone[at] != pair]
            asked.add(q[may].astype(asked.code.dtype), items[of[may]], score[may], None if norms is None else norms[of[may]])

    def block(asked: pa.Table | _Asked, lists: pa.Table | dict | None) -> pa.Table | None:
        if not isinstance(asked, pa.Table):
            return passing(asked, lists)
        out: list[tuple] = []
        query_type, item_type = asked.schema.field("query").type, asked.schema.field("item").type
        dims = lists["of_dim"].combine_chunks()
        flat = pc.list_flatten(lists["items"]).combine_chunks()
        names = pc.unique(pa.chunked_array([flat, asked["item"].drop_null().combine_chunks()]))
        names = names.take(pc.array_sort_indices(names))
        code_of = lambda values: np.asarray(pc.index_in(values, names).fill_null(0)).astype(np.int64)
        codes, weights = code_of(flat), pc.list_flatten(lists["weights"]).combine_chunks().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists["items"]).combine_chunks()))]).astype(np.int64)
        divisor = np.ones(len(names))
        if digits is None:
            divisor[codes] = pc.list_flatten(lists["norms"]).combine_chunks().to_numpy(zero_copy_only=False)

        def key(found: np.ndarray, score: np.ndarray) -> np.ndarray:
            return rounded(score) if digits is not None else np.rint(score * unit) / unit / (np.rint(divisor[found] * unit) / unit)

        end_w = np.nan_to_num(lists["end_w"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.float64))
        end_item = code_of(lists["end_item"].combine_chunks())
        queries = pc.unique(asked["query"].combine_chunks())
        of = np.asarray(pc.index_in(asked["query"].combine_chunks(), queries)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        gone = asked["item"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)[order]
        dim = np.asarray(pc.index_in(asked["dim"].combine_chunks(), dims).fill_null(-1)).astype(np.int64)[order]
        item, qw = code_of(asked["item"].combine_chunks())[order], np.nan_to_num(asked["qw"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.float64))[order]
        cuts = np.searchsorted(of[order], np.arange(len(queries) + 1))

        def totals(d: np.ndarray, factor: np.ndarray, use_weights: bool) -> tuple[np.ndarray, np.ndarray]:
            """(items, sums) of the lists `d` times `factor`."""
            lengths = starts[d + 1] - starts[d]
            ends = np.cumsum(lengths)
            whole = len(d) > 0 and ends[-1] * 8 > len(names)
            dense, some = np.zeros(len(names) if whole else 0), []
            i = 0
            while i < len(d):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE, "right")))
                n = lengths[i:j]
                at = np.arange(n.sum()) + np.repeat(starts[d[i:j]] - (np.cumsum(n) - n), n)
                value = np.repeat(factor[i:j], n)
                if use_weights:
                    value *= weights[at]
                if whole:
                    dense += np.bincount(codes[at], value, len(names))
                else:
                    some.append((codes[at], value))
                i = j
            if whole:
                hit = np.flatnonzero(dense > 0)
                return hit, dense[hit]
            if not some:
                return np.empty(0, np.int64), np.empty(0)
            found, back = np.unique(np.concatenate([c for c, _ in some]), return_inverse=True)
            return found, np.bincount(back, np.concatenate([v for _, v in some]), len(found))

        def emit(q: int, at: np.ndarray, values: np.ndarray, complete: bool) -> None:
            out.append((np.full(len(at), q), at, values, np.full(len(at), complete)))

        for q, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            mine = slice(a, b)
            use = ~gone[mine] & (dim[mine] >= 0)
            d, w = dim[mine][use], qw[mine][use]
            found, score = totals(d, w, True)
            left = item[mine][gone[mine]]
            if len(left):
                keep = ~np.isin(found, left)
                found, score = found[keep], score[keep]
            keep = score > 0
            found, score = found[keep], score[keep]
            cut = end_w[d] > 0
            if not cut.any():
                top = best(found, key(found, score))
                emit(q, found[top], score[top], True)
                continue
            # lists are cut: what an item can still gain
            ends, wc = end_w[d[cut]], w[cut]
            most = float((wc * ends).sum())
            spread_ = float(np.sqrt((wc * wc).sum()) * norm)
            keys = key(found, score)
            top = best(found, keys)
            kth = keys[top[-1]] if len(top) == k else -1.0
            closed = kth > rounded(min(most, spread_) * (1 + SLACK)) or (
                kth >= rounded(most) * (1 - tied) and found[top[-1]] <= end_item[d[cut]].max())
            if not closed:
                out.append((np.array([q]), np.array([-1]), np.zeros(1), np.array([False])))
                continue
            has, held = totals(d[cut], wc * ends, False)
            gain = np.full(len(found), most)
            where = np.searchsorted(has, found)
            inside = (where < len(has)) & (has[np.minimum(where, len(has) - 1)] == found)
            gain[inside] -= held[where[inside]]
            may = rounded((score / divisor[found] + np.minimum(gain, spread_)) * (1 + SLACK)) >= kth
            emit(q, found[may], score[may], False)
        if not out:
            out = [(np.empty(0, np.int64),) * 2 + (np.empty(0), np.empty(0, bool))]
        q, at, value, complete = (np.concatenate(c) for c in zip(*out, strict=True))
        shown = pa.array(np.where(at < 0, 0, at), mask=at < 0)
        return pa.table({"query": queries.take(pa.array(q)).cast(query_type), "item": (names.take(shown) if len(names) else pa.nulls(len(at), item_type)).cast(item_type),
                         "score": pa.array(value), "norm": pa.array(np.where(at < 0, 1.0, divisor[np.maximum(at, 0)] if len(names) else 1.0)), "complete": pa.array(complete)})

    return block


def _numbers(x: np.ndarray) -> bytes:
    """Whole numbers from 0, in as few bytes as the largest needs; the last byte tells how many."""
    size = next(n for n in (1, 2, 4, 8) if n == 8 or int(x.max(initial=0)) < 1 << 8 * n)
    return x.astype(f"<u{size}").tobytes() + bytes([size])


def _read(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[-1]}", count=(len(b) - 1) // b[-1])


#: How weights travel: distinct dimensions as steps, how often each occurs, whose weight it is, the weight as it is or by its place among the distinct ones.
PACKED = "base bigint, step binary, n binary, code binary, w binary, place binary"


def _packed(dim: np.ndarray, code: np.ndarray, w: np.ndarray) -> dict:
    """One row of weights, given in the order of their dimensions."""
    first = np.flatnonzero(np.concatenate([[True], dim[1:] != dim[:-1]]))
    steps = np.diff(dim[first].view(np.uint64), prepend=dim[:1].view(np.uint64))
    values, place = np.unique(w, return_inverse=True)
    few = 4 * len(values) < len(w)
    return {"base": int(dim[0]), "step": _numbers(steps), "n": _numbers(np.diff(np.append(first, len(dim)))), "code": _numbers(code),
            "w": (values if few else w).tobytes(), "place": _numbers(place) if few else None}


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct dimensions, number of weights of each, codes, weights)."""
    steps, base = _read(row["step"]).astype(np.uint64), np.array([row["base"]]).view(np.uint64)
    w = np.frombuffer(row["w"])
    return (np.cumsum(steps) + base).view(np.int64), _read(row["n"]).astype(np.int64), _read(row["code"]), w if row["place"] is None else w[_read(row["place"])]


def _named(values: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order, and the place of each value among them."""
    names = pc.unique(values)
    names = names.take(pc.array_sort_indices(names))
    return names, np.asarray(pc.index_in(values, names).combine_chunks()).astype(np.int64)


def _pieces(size: int, kind: pa.DataType, normed: bool):
    """The task that packs whole items into pieces of about `size` weights."""

    def run(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        t = pa.Table.from_batches(held)
        names, code = _named(t["item"])
        dim, w = t["dim"].to_numpy(), t["iw"].to_numpy()
        chunk = t["chunk"][0].as_py()
        counts = np.bincount(code, minlength=len(names))
        piece = (np.cumsum(counts) - counts) // size
        norms = np.empty(len(names))
        norms[code] = t["norm"].to_numpy()
        order = np.lexsort((dim, piece[code]))
        code, dim, w = code[order], dim[order], w[order]
        cuts = np.flatnonzero(np.diff(piece[code], prepend=-1, append=-1))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            low, high = int(code[a:z].min()), int(code[a:z].max()) + 1
            row = _packed(dim[a:z], code[a:z] - low, w[a:z]) | {"chunk": chunk, "item": names[low:high], "norm": norms[low:high].tobytes() if normed else None}
            yield _row(row, kind, None)

    return run


def _row(row: dict, item: pa.DataType, query: pa.DataType | None) -> pa.RecordBatch:
    kinds = {"block": pa.int32(), "chunk": pa.int32(), "query": query and pa.list_(query), "item": pa.list_(item), "base": pa.int64(),
             **{c: pa.binary() for c in ("step", "n", "code", "w", "place", "norm")}}
    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x).cast(kind) if isinstance(x, pa.Array) else pa.array([x], kind)
    names = [c for c in kinds if (c != "query" and c != "block" if query is None else c != "norm")]
    return pa.RecordBatch.from_arrays([one(row.get(c), kinds[c]) for c in names], names=names)


def _blocks(item: pa.DataType, query: pa.DataType):
    """The task that packs the queries of a block, and for each chunk what they are not to find."""

    def run(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        t = pa.Table.from_batches(held)
        block = t["block"][0].as_py()
        asked = t.filter(pc.is_null(t["item"]))
        names, code = _named(asked["query"])
        dim, w = asked["dim"].to_numpy(), asked["qw"].to_numpy()
        order = np.argsort(dim, kind="stable")
        yield _row(_packed(dim[order], code[order], w[order]) | {"block": block, "query": names}, item, query)
        gone = t.filter(pc.is_valid(t["item"])).sort_by([("chunk", "ascending"), ("item", "ascending")])
        if len(gone):
            code, chunk, items = np.asarray(pc.index_in(gone["query"], names).combine_chunks()).astype(np.int64), gone["chunk"].to_numpy(), gone["item"].combine_chunks()
            cuts = np.append(np.flatnonzero(np.diff(chunk, prepend=-1)), len(chunk))
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                yield _row({"block": block, "chunk": int(chunk[a]), "code": _numbers(code[a:z]), "item": items[a:z]}, item, query)

    return run


class _Asked:
    """The queries of a block, by dimension, with what they are not to find in the piece at hand and the best items so far."""

    def __init__(self, row: dict, k: int, key: Callable[[np.ndarray, np.ndarray | None], np.ndarray]):
        self.names, self.k, self.key = row["query"], k, key
        self.dims, n, code, self.w = _unpacked(row)
        self.starts = np.concatenate([[0], np.cumsum(n)])
        self.code = code.astype(np.uint16 if len(self.names) <= 1 << 16 else np.int64)  # short numbers are sorted by their digits
        self.kth = np.full(len(self.names), -np.inf)
        self.gone = np.empty(0, np.int64), np.empty(0, np.int64)  # (codes, items)
        self.here, self.met = self.gone, np.empty(0, bool)
        self.found: list[tuple] = []
        self.waiting = 0

    def __getitem__(self, column: str) -> pa.Array:
        """The excluded pairs of the piece at hand, as a table of rows has them."""
        return self.names.take(pa.array(self.here[0])) if column == "query" else pa.array(self.here[1])

    def meet(self, items: np.ndarray) -> None:
        """Excluded pairs of these items (ascending) are at hand."""
        low, high = np.searchsorted(self.gone[1], items), np.searchsorted(self.gone[1], items, "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        self.here, self.met[at] = (self.gone[0][at], self.gone[1][at]), True

    def unmet(self) -> None:
        """The pairs whose items have no weights are at hand."""
        self.here = self.gone[0][~self.met], self.gone[1][~self.met]

    def add(self, q: np.ndarray, item: np.ndarray, score: np.ndarray, norm: np.ndarray | None) -> None:
        self.found.append((q, item, score, norm))
        self.waiting += len(q)
        if self.waiting > KEPT:
            self.prune()

    def prune(self, exact: bool = False) -> None:
        """Leave what reaches the `k`-th key of its query, or the first `k` only."""
        parts = list(zip(*self.found, strict=True))
        self.found = []
        q, item, score = (np.concatenate(c) for c in parts[:3])
        norm = None if parts[3][0] is None else np.concatenate(parts[3])
        parts.clear()
        key = self.key(score, norm)
        n = np.bincount(q, minlength=len(self.names))
        first, keys = np.cumsum(n) - n, key[np.argsort(q, kind="stable")]
        size = np.where(n > self.k, np.ceil(np.log2(np.maximum(n, 1))), -1)
        for s in np.unique(size[size >= 0]):  # queries of like numbers of items side by side
            which = np.flatnonzero(size == s)
            width = int(n[which].max())
            rows = np.full((len(which), width), -np.inf)
            rows[np.arange(width)[None, :] < n[which][:, None]] = keys[np.arange(n[which].sum()) + np.repeat(first[which] - (np.cumsum(n[which]) - n[which]), n[which])]
            rows.partition(width - self.k, axis=1)
            self.kth[which] = rows[:, width - self.k]
        may = np.flatnonzero(key >= self.kth[q])
        if exact or len(may) > self.k * len(self.names) + KEPT // 4:
            ties = item[may] if item.dtype != object else np.unique(item[may], return_inverse=True)[1]
            may = may[np.lexsort((ties, -key[may], q[may]))]
            n = np.bincount(q[may], minlength=len(self.names))
            may = may[np.arange(len(may)) - np.repeat(np.cumsum(n) - n, n) < self.k]
        self.found = [(q[may], item[may], score[may], None if norm is None else norm[may])]
        self.waiting = 0

    def best(self, item_type: pa.DataType, query_type: pa.DataType):
        if self.found:
            self.prune(exact=True)
            q, item, score, norm = self.found[0]
            norm = np.ones(len(q)) if norm is None else norm
            for a in range(0, len(q), 1 << 16):
                at = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([self.names.take(pa.array(q[at])).cast(query_type), pa.array(item[at], item_type), pa.array(score[at]), pa.array(norm[at])],
                                                 names=["query", "item", "score", "norm"])


def _tiled(queries: DataFrame, items: DataFrame, exclude: DataFrame | None, sizes: DataFrame, k: int, digits: int | None,
           held: int, n_rows: int, entries: int) -> DataFrame:
    """The best `k` of every query in every chunk of the items: a block of queries meets a chunk of whole items in one tile.

    A tile holds its queries, by dimension, and the best items so far; the items pass by in packed pieces. The items' weights go once to each
    block, the queries' once to each chunk, an excluded pair to one tile; the number of products does not matter to what is shuffled. The blocks
    take turns, a few at a time, and what a turn has shuffled is deleted at its end, so the disk holds a few times the items' weights.
    """
    spark = queries.sparkSession
    query_type, item_type = dict(queries.dtypes)["query"], dict(items.dtypes)["item"]
    if not {dict(df.dtypes)["dim"] for df in (queries, items)} <= {"tinyint", "smallint", "int", "bigint"}:  # numbers are shorter
        number = materialise(sizes.select("dim", F.monotonically_increasing_id().alias("_dim")))
        queries, items = (df.join(number, "dim").drop("dim").withColumnRenamed("_dim", "dim") for df in (queries, items))
    cores = spark.sparkContext.defaultParallelism
    chunks = -(-held // entries)
    n_asked, n_queries = queries.agg(F.count(F.lit(1)), F.count_distinct("query")).first()
    blocks = max(-(-(n_asked + -(-(n_rows - n_asked) // chunks)) // BLOCK_ROWS), -(-n_queries // max(1, min(BLOCK_QUERIES, BLOCK_BEST // k))), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // chunks))
    of_item, of_query = (to_arrow_type(df.schema[c].dataType) for df, c in ((items, "item"), (queries, "query")))
    parts = chunks * max(1, -(-held // (chunks * PART)), -(-cores // chunks))
    part = F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int")
    whole = items.select(part.alias("part"), (part % chunks).alias("chunk"), "item", F.col("dim").cast("bigint").alias("dim"), "iw", "norm")
    pieces = materialise(whole.repartitionById(parts, F.col("part")).mapInArrow(
        _pieces(min(PACK, entries), of_item, digits is None), f"chunk int, item array<{item_type}>, {PACKED}, norm binary"))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")
    rows = queries.select(block, "query", F.col("dim").cast("bigint").alias("dim"), "qw", F.lit(None).cast(item_type).alias("item"), F.lit(None).cast("int").alias("chunk"))
    if exclude is not None:  # to the chunk of its item only
        rows = rows.unionByName(exclude.select(block, "query", F.lit(None).cast("bigint").alias("dim"), F.lit(None).cast("double").alias("qw"), "item", (part % chunks).alias("chunk")))
    asked = materialise(rows.repartitionById(blocks, F.col("block")).mapInArrow(
        _blocks(of_item, of_query), f"block int, chunk int, query array<{query_type}>, item array<{item_type}>, {PACKED}"))
    score, unit = _score_block(k, digits, 0.0), float(10 ** (digits or DIGITS))

    def key(x: np.ndarray, norm: np.ndarray | None) -> np.ndarray:
        """What scores are ranked by."""
        return np.floor(x * unit + 0.5) / unit if norm is None else np.rint(x * unit) / unit / (np.rint(norm * unit) / unit)

    def tile(batches):
        asked = None

        def done():
            asked.unmet()
            score(asked, None)
            return asked.best(of_item, of_query)

        for b in batches:
            for i in range(len(b)):
                row = {c: b.column(c)[i] for c in b.schema.names}
                row |= {c: row[c].as_py() for c in ("kind", "base", "step", "n", "code", "w", "place", "norm")} | {c: row[c].values for c in ("query", "item")}
                if row["kind"] == 0:
                    if asked is not None:
                        yield from done()
                    asked = _Asked(row, k, key)
                elif row["kind"] == 1:
                    asked.gone = _read(row["code"]).astype(np.int64), row["item"].to_numpy(zero_copy_only=False)
                    asked.met = np.zeros(len(asked.gone[0]), bool)
                else:
                    row["item"] = row["item"].to_numpy(zero_copy_only=False)
                    asked.meet(row["item"])
                    score(asked, row)
        if asked is not None:
            yield from done()

    columns = ["query", "item", "base", "step", "n", "code", "w", "place", "norm"]
    turn = min(blocks, max(1, -(-2 * cores // chunks)))
    found = []
    for start in range(0, blocks, turn):
        end = min(start + turn, blocks)
        number = ((F.col("block") - start) * chunks + F.col("chunk")).cast("int").alias("tile")
        every = lambda a, z: F.explode(F.sequence(F.lit(a), F.lit(z - 1)))
        mine = asked.filter(F.col("block").between(start, end - 1)).withColumn("norm", F.lit(None).cast("binary"))
        to_all = mine.filter("chunk is null").withColumn("chunk", every(0, chunks)).select(number, F.lit(0).alias("kind"), *columns)
        gone = mine.filter("chunk is not null").select(number, F.lit(1).alias("kind"), *columns)
        passing = pieces.withColumns({"block": every(start, end), "query": F.lit(None).cast(f"array<{query_type}>")}).select(number, F.lit(2).alias("kind"), *columns)
        sent = to_all.unionByName(gone).unionByName(passing).repartitionById((end - start) * chunks, F.col("tile")).sortWithinPartitions("tile", "kind")
        best = materialise(sent.mapInArrow(tile, f"query {query_type}, item {item_type}, score double, norm double"), {BATCH: "8"})
        if chunks > 1 and blocks > turn:
            first = materialise(_best(best, k, digits).select("query", "item", "score", "norm"))
            discard(best)
            best = first
        found.append(best)
    discard(pieces, asked, queries, items)
    return reduce(DataFrame.unionByName, found)


def top_scores(queries: DataFrame, items: DataFrame, k: int, exclude: DataFrame | None = None,
               hot_limit: int = HOT_LIMIT, digits: int | None = DIGITS, first_depth: int | None = None, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Best `k` items per query, positive scores only: `query`, `item`, `score`, `rank`.

    queries: (query, dim, qw); items: (item, dim, iw); exclude: (query, item), each row once. Rows without query, item or dimension
    take no part. Scores are rounded to `digits` before ranking, ties go to the lower item. With `digits` None items have a `norm` too, the same in
    all rows of an item: they are ranked by their rounded score over their rounded norm, and the result has the plain score and the norm.

    Queries are dealt into blocks. A dimension is one list of items, sent once to each block that asks for it, and all
    products of a query are summed up in its block's task, so that neither products nor sums are shuffled.

    Of a dimension with more than `hot_limit` items the list holds the heaviest ones only, `first_depth` at first. What an item outside can still gain
    is bounded by the weights at which the lists end and by the norms of the cut parts. A query whose `k`-th score beats that
    is done: its task hands on each item that can still be among the best, and only these are completed by lookup. The lists of the other queries
    grow fourfold until all are done, so the result is exact. A query that alone needs more than `block_entries` is joined outright.

    Where the items have more than `block_entries` weights and the queries are not few against them, blocks would ask for most
    lists again and again. Then whole items meet in tiles (see `_tiled`) with nothing cut, unless dimensions beyond
    `hot_limit` alone make more than `hot_limit` products for each query weight, or one query or item fills a tile.
    """
    spark = queries.sparkSession
    queries = materialise(queries.filter("query is not null and dim is not null").select("query", "dim", F.col("qw").cast("double").alias("qw")))
    norm_of = F.col("norm") if digits is None else F.lit(1.0)
    own = F.round("iw", DIGITS) / F.round(norm_of, DIGITS) if digits is None else F.col("iw")
    items = materialise(items.filter("item is not null and dim is not null").select("item", "dim", F.col("iw").cast("double").alias("iw"), norm_of.alias("norm")))
    query_type, item_type = dict(queries.dtypes)["query"], dict(items.dtypes)["item"]
    if exclude is not None:
        exclude = exclude.filter("query is not null and item is not null").select(F.col("query").cast(query_type).alias("query"), F.col("item").cast(item_type).alias("item"))
        exclude = materialise(exclude.join(queries.select("query").distinct(), "query", "left_semi"))
    sizes = materialise(items.groupBy("dim").agg(F.count(F.lit(1)).alias("n_items")))
    hot = sizes.filter(F.col("n_items") > hot_limit)
    some_hot = not hot.isEmpty()
    held = sizes.agg(F.sum("n_items")).first()[0] or 0
    if held > block_entries:
        sent = queries if exclude is None else queries.select("query").unionByName(exclude.select("query"))
        n_rows, longest = sent.groupBy("query").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
        fits = 8 * n_rows >= held and longest <= BLOCK_ROWS
        if fits and some_hot:
            fits = (queries.join(hot, "dim").agg(F.sum("n_items")).first()[0] or 0) <= hot_limit * n_rows
        if fits and items.groupBy("item").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] <= block_entries:
            return _placed(_tiled(queries, items, exclude, sizes, k, digits, held, n_rows, min(TILE_ENTRIES, block_entries)), k, digits)
    no_end = [F.lit(None).cast("double").alias("end_w"), F.lit(None).cast(item_type).alias("end_item")]
    cold = items if not some_hot else items.join(hot.select("dim"), "dim", "left_anti")
    cold_lists = materialise(_lists(cold).select("*", *no_end))
    norm, hot_items = 0.0, None
    if some_hot:
        hot_items = materialise(items.join(hot.select("dim"), "dim", "left_semi").withColumn("own", own))
        norm = hot_items.groupBy("item").agg(F.sqrt(F.sum(F.col("own") * F.col("own"))).alias("n")).agg(F.max("n")).first()[0]
    depth = first_depth or max(4 * k, 256)
    open_q, done = None, []
    while True:
        asked = queries if open_q is None else queries.join(open_q, "query", "left_semi")
        left_out = exclude if exclude is None or open_q is None else exclude.join(open_q, "query", "left_semi")
        need = F.when(F.col("n_items") > hot_limit, F.least("n_items", F.lit(depth))).otherwise(F.col("n_items"))
        load = asked.join(sizes, "dim", "left").select("query", F.coalesce(need, F.lit(0)).alias("need"))
        if left_out is not None:
            load = load.unionByName(left_out.select("query", F.lit(1).alias("need")))
        load = materialise(load.groupBy("query").agg(F.sum("need").alias("need"), F.count(F.lit(1)).alias("rows")))
        n_need, n_rows, most = load.agg(F.sum("need"), F.sum("rows"), F.max("need")).first()
        if n_need is None:
            break
        if most > block_entries:
            heavy = materialise(load.filter(F.col("need") > block_entries).select("query"))
            out = None if left_out is None else left_out.join(heavy, "query", "left_semi")
            done.append(_summed(_products(asked.join(heavy, "query", "left_semi"), items), out))
            asked = asked.join(heavy, "query", "left_anti")
            left_out = None if left_out is None else left_out.join(heavy, "query", "left_anti")
        lists = cold_lists
        if some_hot:
            heads = materialise(_heads(hot_items, sizes, depth))
            end = F.max(F.when((F.col("place") == depth) & (F.col("n_items") > depth), F.struct("own", "item"))).alias("end")
            hot_lists = _lists(heads, end).select("dim", "items", "weights", "norms", F.col("end.own").alias("end_w"), F.col("end.item").alias("end_item"))
            lists = lists.unionByName(hot_lists)
        blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // BLOCK_ROWS), 1 if held <= block_entries else -(-int(n_need) // block_entries))
        of = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")
        rows = asked.select(of, "query", "dim", "qw", F.lit(None).cast(item_type).alias("item"))
        sent = rows.select(F.col("block").alias("to"), F.col("dim").alias("of_dim")).distinct().join(lists.withColumnRenamed("dim", "of_dim"), "of_dim")
        if left_out is not None:
            rows = rows.unionByName(left_out.select(of, "query", F.lit(None).cast(dict(queries.dtypes)["dim"]).alias("dim"), F.lit(None).cast("double").alias("qw"), "item"))
        found = rows.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(
            _score_block(k, digits, norm or 0.0), f"query {query_type}, item {item_type}, score double, norm double, complete boolean")
        if not some_hot:
            done.append(found.select("query", "item", "score", "norm"))
            break
        found = materialise(found)
        done.append(found.filter("complete").select("query", "item", "score", "norm"))
        partial = found.filter("item is not null and not complete").select("query", "item", "score", "norm")
        tails = hot_items.join(heads.select("dim", "item"), ["dim", "item"], "left_anti")
        gains = (
            partial.select("query", "item").join(asked.join(hot.select("dim"), "dim", "left_semi"), "query").join(tails, ["dim", "item"])
            .select("query", "item", (F.col("qw") * F.col("iw")).alias("score"), "norm")
        )
        done.append(partial.unionByName(gains).groupBy("query", "item").agg(F.sum("score").alias("score"), F.max("norm").alias("norm")))
        open_q = found.filter("item is null").select("query")
        if open_q.isEmpty():
            break
        open_q, depth = materialise(open_q), 4 * depth
    none = queries.select("query", F.lit(None).cast(item_type).alias("item"), F.col("qw").alias("score"), F.lit(1.0).alias("norm")).limit(0)
    return _placed(reduce(DataFrame.unionByName, done or [none]), k, digits)


def _best(found: DataFrame, k: int, digits: int | None) -> DataFrame:
    whole = found.withColumn("key", _key(F.col("score"), F.col("norm"), digits)).filter(F.col("key") > 0)
    return top_n_per_key(whole, ["query"], [F.desc("key"), F.asc("item")], k)


def _placed(found: DataFrame, k: int, digits: int | None) -> DataFrame:
    top = _best(found, k, digits)
    return top.drop("key") if digits is None else top.select("query", "item", F.col("key").alias("score"), "rank")


def copy_classes(vectors: DataFrame) -> DataFrame:
    """Group items with identical (dim, weight) sets: (`item`, `class`, `place`).

    The class is its lowest item id; `place` counts its members from 0 by id.
    Members are placed range by range when a class is hot.
    """
    prints = vectors.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("dim", "iw")).alias("h1"),
        F.bit_xor(F.xxhash64(F.lit(1), "dim", "iw")).alias("h2"),
    )
    prints = materialise(prints)
    heads = prints.groupBy("n", "h1", "h2").agg(F.min("item").alias("class"))
    return place_members(prints.join(heads, ["n", "h1", "h2"]).select("item", "class"))


def place_members(classes: DataFrame, hot_limit: int = 1_000_000) -> DataFrame:
    from opinara.operators.toprows import user_halves

    placed = user_halves(classes, ["item"], "class", hot_limit)
    return placed.select("item", "class", F.col("position").alias("place"))


def expand_classes(ranked: DataFrame, members: DataFrame, k: int, exclude: DataFrame | None = None) -> DataFrame:
    """Replace classes by their members: best `k` items per query.

    ranked: (query, class, score), long enough for `k` items after exclusions.
    Each class gives its first `k` members plus as many as it has excluded ones;
    members are joined in blocks, so a huge class is never joined whole.
    """
    block = max(k, 16)
    if exclude is not None:
        gone = exclude.select("query", "item").distinct().join(members, "item").groupBy("query", "class").agg(F.count(F.lit(1)).alias("gone"))
        need = ranked.join(gone, ["query", "class"], "left").withColumn("need", F.coalesce("gone", F.lit(0)) + k)
    else:
        need = ranked.withColumn("need", F.lit(k).cast("long"))
    blocks = need.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("need") - 1) / block))))
    blocked = members.withColumn("block", F.floor(F.col("place") / block))
    rows = blocks.join(blocked, ["class", "block"]).filter(F.col("place") < F.col("need")).select("query", "item", "score")
    if exclude is not None:
        rows = rows.join(exclude.select("query", "item"), ["query", "item"], "left_anti")
    return _ranked(rows, k)
