"""Top partners of every entity by sums over shared keys.

Similar users share items; similar items share users. The plain self-join on
the key costs the square of the key's rows, so keys are split by size:

* Keys with at most `hot_limit` rows are self-joined, as lists that meet in the
  tasks of their entities. The join emits at most `hot_limit` rows per input row. What the pairs found share of the hot keys is
  looked up pair by pair.
* A query whose `k`-th partner already beats anything that shares hot keys only
  is done.
* For the other queries the rows of hot keys are still not joined row by row.
  What an entity holds of the hot keys is its pattern; entities with equal
  patterns are interchangeable as far as those keys go. Patterns are compared
  with patterns, each pattern keeps its best `k + 1` members, and every entity
  takes the list of its own pattern.

An entity outside the candidates shares no small key with the query and has
`k` better members ahead of it in its pattern, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.scalars import fixed
from opinara.operators.toprows import hot_keys, top_n_per_key
from opinara.session import discard, materialise

HOT_LIMIT = 2_000
PAIRS = 2_000_000  # joined rows of a block
TURN = 8  # blocks of a core that are sent at a time
SLICE = 1 << 20  # joined rows that are added up at once
SAMPLE = np.ones((5, 1))  # to see which sums are whole numbers
SLACK = 1e-8  # scores are rounded before ranking


def distance(a, b):
    """|a - b| of columns or arrays."""
    return F.abs(a - b) if isinstance(a, Column) else np.abs(a - b)


def fixed_of(x):
    """`fixed` of a column or an array."""
    return fixed(x) if isinstance(x, Column) else np.floor(x * 1e9 + 0.5) / 1e9


def _side(df: DataFrame, entity: str, key: str, value: str, attrs: list[str], s: str) -> DataFrame:
    return df.select(
        F.col(entity).alias(f"{s}_id"), F.col(key).alias("_key"), F.col(value).alias(f"{s}_value"),
        *[F.col(x).alias(f"{s}_{x}") for x in attrs],
    )


def _reduced(a: np.ndarray, b: np.ndarray, values: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Rows of equal (`a`, `b`) added up, in order; a NaN counts as null, which a sum leaves out."""
    width = int(b.max()) + 1
    at = a * width + b
    order = np.argsort(at)
    at = at[order]
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    out = {}
    for n, x in values.items():
        x = x[order]
        gaps = np.isnan(x) if x.dtype.kind == "f" else None
        if gaps is not None and gaps.any():
            total = np.add.reduceat(np.where(gaps, 0.0, x), starts)
            total[np.add.reduceat((~gaps).astype(np.int64), starts) == 0] = np.nan
            out[n] = total
        else:
            out[n] = np.add.reduceat(x, starts)
    return at[starts] // width, at[starts] % width, out


def _pair_block(attrs: list[str], sums: dict, order: Callable, k: int | None):
    """The task of a block: the pairs of its entities added up slice by slice, the best `k` of each kept (all without `k`)."""

    def column(table: pa.Table, name: str) -> pa.Array:
        return pc.list_flatten(table[name].combine_chunks())

    def numbers(values: pa.Array) -> np.ndarray:
        """Values as one array; lists of equal length as one row for each place."""
        if not pa.types.is_list(values.type):
            return values.to_numpy(zero_copy_only=False).astype(np.float64)
        return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1).T

    def block(packed: pa.Table) -> pa.Table:
        own, other = column(packed, "a_id"), column(packed, "b_id")
        names = pc.unique(other)
        names = names.take(pc.array_sort_indices(names))
        code = lambda x: np.asarray(pc.index_in(x, names)).astype(np.int64)
        a, b, av, bv = code(own), code(other), numbers(column(packed, "a_value")), numbers(column(packed, "b_value"))
        of = {c: np.full(len(names), np.nan) for c in attrs}
        for c in attrs:
            of[c][b] = numbers(column(packed, f"b_{c}"))
        size = lambda c: np.asarray(pc.list_value_length(packed[c].combine_chunks())).astype(np.int64)
        lengths, held = size("b_id"), size("a_id")
        first = np.cumsum(lengths) - lengths
        key = np.repeat(np.arange(len(lengths)), held)
        by_a = np.argsort(a, kind="stable")
        a, av, n, begin = a[by_a], av[..., by_a], lengths[key][by_a], first[key][by_a]
        ends = np.cumsum(n)
        out, i, left = [], 0, None
        while i < len(a):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE, "right")))
            m = n[i:j]
            at = np.arange(m.sum()) + np.repeat(begin[i:j] - (np.cumsum(m) - m), m)
            mine = np.repeat(np.arange(i, j), m)
            apart = a[mine] != b[at]
            at, mine = at[apart], mine[apart]
            x, y = av[..., mine], bv[..., at]
            pa_, pb = a[mine], b[at]
            values = {s: np.broadcast_to(v := fn(x, y), len(at)).astype(np.int64 if isinstance(v, int) else np.float64) for s, fn in sums.items()}
            if left is not None:
                pa_, pb = np.concatenate([left[0], pa_]), np.concatenate([left[1], pb])
                values = {s: np.concatenate([left[2][s], v]) for s, v in values.items()}
                left = None
            if len(pa_):
                pa_, pb, values = _reduced(pa_, pb, values)
                if j < len(a):  # the last entity may go on in the next slice
                    cut = int(np.searchsorted(pa_, a[j]))
                    left = pa_[cut:], pb[cut:], {s: v[cut:] for s, v in values.items()}
                    pa_, pb, values = pa_[:cut], pb[:cut], {s: v[:cut] for s, v in values.items()}
            if len(pa_):
                out.append(best(pa_, pb, values, of))
            i = j
        if not out:
            out = [(np.empty(0, np.int64), np.empty(0, np.int64), {s: np.empty(0) for s in sums}, np.empty(0, np.int32))]
        a, b = (np.concatenate([o[x] for o in out]) for x in (0, 1))
        table = {"a_id": names.take(pa.array(a)), "b_id": names.take(pa.array(b))}
        for side, x in (("a", a), ("b", b)):
            table |= {f"{side}_{c}": pa.array(of[c][x], pa.float64(), from_pandas=True) for c in attrs}
        table |= {s: pa.array(np.concatenate([o[2][s] for o in out]), from_pandas=True) for s in sums}
        return pa.table(table | {"rank": pa.array(np.concatenate([o[3] for o in out]).astype(np.int32))})

    def best(a, b, values, of):
        if k is None:
            return a, b, values, np.zeros(len(a), np.int32)
        v = values | {f"{side}_{c}": of[c][x] for side, x in (("a", a), ("b", b)) for c in attrs}
        keys = [np.where(np.isnan(x), -np.inf, x) if x.dtype.kind == "f" else x for x in order("a", v)]
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        n = np.diff(np.append(starts, len(a)))
        lead = keys[0] - keys[0].min() if keys[0].dtype.kind == "i" else np.unique(keys[0], return_inverse=True)[1]
        at = (a - a[0]) * (int(lead.max()) + 1) + lead
        kth = np.sort(at)[starts + np.minimum(k, n) - 1]  # entities keep their places
        may = np.flatnonzero(at <= np.repeat(kth, n))
        at = may[np.lexsort([b[may], *(x[may] for x in reversed(keys)), a[may]])]
        starts = np.flatnonzero(np.diff(a[at], prepend=-1))
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at)))) + 1
        at, rank = at[rank <= k], rank[rank <= k]
        return a[at], b[at], {s: x[at] for s, x in values.items()}, rank

    return block


def _joined_sums(edges: DataFrame, entity: str, key: str, value: str, attrs: list[str], sums: dict, order: Callable, k: int | None, n_pairs: int) -> DataFrame:
    """Sums of every ordered pair with a shared key, with `k` only the best of each entity, placed by `rank`.

    A key's entities travel as one packed list to each block of entities that it has some of, and pairs are made and added
    up in the block's task, so that none is shuffled. There is a block for every `PAIRS` of the `n_pairs` joined rows. Blocks take turns,
    `TURN` for each core, and the lists that a turn has shuffled are deleted at its end.
    """
    blocks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-n_pairs // PAIRS))
    of = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    columns = {"value": value, "id": entity} | {f"of_{c}": c for c in attrs}
    entry = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])  # sorted: equal values side by side pack well
    lists = edges.filter(F.col(key).isNotNull() & F.col(entity).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("l"))
    lists = lists.filter(F.size("l") > 1).select("l")
    kind = dict(edges.dtypes)[entity]
    more = [*[f"{s}_{c} double" for s in ("a", "b") for c in attrs], *[f"{n} {'bigint' if isinstance(fn(SAMPLE, SAMPLE), int) else 'double'}" for n, fn in sums.items()]]
    task = _pair_block(attrs, sums, order, k)
    turn = TURN * edges.sparkSession.sparkContext.defaultParallelism
    if blocks > turn:
        lists = materialise(lists)

    def sums_of(start: int, end: int) -> DataFrame:
        inside = F.filter(F.array_distinct(F.transform("l", lambda x: of(x["id"]))), lambda x: x.between(start, end - 1))
        sent = lists.select("l", F.explode(F.transform(inside, lambda x: x - start)).alias("_block")).withColumn("own", F.filter("l", lambda x: of(x["id"]) == F.col("_block") + start))
        packed = sent.select("_block", F.col("own.id").alias("a_id"), F.col("own.value").alias("a_value"), *[F.col(f"l.{n}").alias(f"b_{n.removeprefix('of_')}") for n in columns])
        return packed.repartitionById(end - start, F.col("_block")).groupBy("_block").applyInArrow(task, f"a_id {kind}, b_id {kind}, {', '.join(more)}, rank int")

    if blocks <= turn:
        return sums_of(0, blocks)
    found = [materialise(sums_of(start, min(start + turn, blocks))) for start in range(0, blocks, turn)]
    discard(lists)
    return reduce(DataFrame.unionByName, found)


def _sorted_by(order: Callable, a: str | None, names: list[str]) -> list[Column]:
    return [F.asc(c) for c in order(a, {n: F.col(n) for n in names})]


def top_partners(
    edges: DataFrame,
    k: int,
    *,
    entity: str,
    key: str,
    value: str,
    sums: dict[str, Callable[[Column, Column], Column]],
    order: Callable[[str | None, dict], list],
    members: list[Column] | None = None,
    attrs: list[str] | None = None,
    pattern_attrs: list[str] | None = None,
    lead: Column | None = None,
    bound: Column | None = None,
    hot_limit: int = HOT_LIMIT,
) -> DataFrame:
    """The best `k` partners of every entity: `a_id`, `b_id`, the sums, `rank`.

    edges: one row per (entity, key). `sums` are symmetric, non-negative and
    grow with every shared key. They and `order` take columns as well as numpy arrays
    (a value that is a list comes as one array for each place); a sum of plain 1 counts.
    `order(x, v)` gives what to sort by, ascending, from `v`, the sums
    and attributes by name (numbers), best first; with `x` an `a_` attribute may scale every
    score of one query alike, with None it must not appear, unless it is one of
    `pattern_attrs`: entities then share a pattern only if these are equal too.
    `members` ranks entities with equal sums by their `b_` attributes. The
    partner id is always the last sort column. `lead` is the score the order
    opens with; `bound`, over an entity's sums with itself on the hot keys, the
    largest of these among all entities (`peak_` before their names) and its
    plain attributes, is the most `lead` can be without a shared small key.
    """
    attrs, same = attrs or [], pattern_attrs or []
    edges = materialise(edges)
    sizes = edges.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= hot_limit)
    n_pairs = sizes.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
    hot = hot_keys(edges, [key], hot_limit)
    names = list(sums)
    tie = [F.asc("b_id")]
    if hot is None:
        return _joined_sums(edges, entity, key, value, attrs, sums, order, k, n_pairs)

    of_columns = lambda x: _sorted_by(order, x, [*names, *(f"{s}_{c}" for s in ("a", "b") for c in attrs)])
    total = lambda fn, a, b: F.sum(F.lit(v) if isinstance(v := fn(F.col(a), F.col(b)), int) else v)

    small = edges.join(hot, key, "left_anti")
    large = materialise(edges.join(hot, key, "left_semi"))

    # Pairs with a shared small key, completed by what they share of the hot keys.
    found = materialise(_joined_sums(small, entity, key, value, attrs, sums, order, None, n_pairs).drop("rank"))
    a, b = _side(large, entity, key, value, [], "a"), _side(large, entity, key, value, [], "b")
    hot_part = (
        found.select("a_id", "b_id").join(a, "a_id").join(b, ["b_id", "_key"]).groupBy("a_id", "b_id")
        .agg(*[total(fn, "a_value", "b_value").alias(f"_{n}") for n, fn in sums.items()])
    )
    pairs = found.join(hot_part, ["a_id", "b_id"], "left").select(
        "a_id", "b_id", *[f"{s}_{c}" for s in ("a", "b") for c in attrs],
        *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names],
    )
    pairs = materialise(pairs)
    first = materialise(top_n_per_key(pairs, ["a_id"], [*of_columns("a"), *tie], k))

    # Order-free 128-bit fingerprint of what an entity holds of the hot keys.
    of = materialise(
        large.groupBy(F.col(entity).alias("id")).agg(
            F.concat_ws(
                ":", F.count(F.lit(1)), F.bit_xor(F.xxhash64(key, value)), F.bit_xor(F.xxhash64(F.lit(1), key, value)),
                *[F.first(c) for c in same],
            ).alias("pattern"),
            *[F.first(c).alias(c) for c in attrs],
            *[total(fn, value, value).alias(n) for n, fn in sums.items()],
        )
    )
    query = of
    if lead is not None and bound is not None:
        peaks = of.agg(*[F.max(n) for n in names]).first()
        of = of.withColumns({f"peak_{n}": F.lit(v) for n, v in zip(names, peaks, strict=True)})
        kth = first.filter(F.col("rank") == k).select(F.col("a_id").alias("id"), lead.alias("_kth"))
        query = of.join(kth, "id", "left").filter(F.col("_kth").isNull() | (F.col("_kth") <= bound + SLACK)).drop("_kth")
    query = materialise(query.select(F.col("id").alias("a_id"), F.col("pattern").alias("pa"), *[F.col(c).alias(f"a_{c}") for c in attrs]))

    # Best members of every pattern for every open pattern, then for every open entity of it.
    reps = of.groupBy("pattern").agg(F.min("id").alias(entity))
    rep_rows = materialise(large.join(reps, entity).select("pattern", key, value))
    open_pattern = query.select(F.col("pa").alias("pattern")).distinct()
    x = rep_rows.join(open_pattern, "pattern", "left_semi").select(F.col("pattern").alias("pa"), key, F.col(value).alias("va"))
    y = rep_rows.select(F.col("pattern").alias("pb"), key, F.col(value).alias("vb"))
    pattern_sums = x.join(y, key).groupBy("pa", "pb").agg(*[total(fn, "va", "vb").alias(n) for n, fn in sums.items()])
    member = of.select(F.col("id").alias("b_id"), F.col("pattern").alias("pb"), *[F.col(c).alias(f"b_{c}") for c in attrs])
    best = top_n_per_key(member, ["pb"], [*(members or []), *tie], k + 1).drop("rank")
    matched = pattern_sums.join(best, "pb")
    if same:
        own = of.groupBy(F.col("pattern").alias("pa")).agg(*[F.first(c).alias(f"a_{c}") for c in same])
        matched = matched.join(own, "pa")
    lists = top_n_per_key(matched, ["pa"], [*of_columns(None), *tie], k + 1).drop("rank", "pb", *[f"a_{c}" for c in same])
    by_pattern = query.join(lists, "pa").filter(F.col("a_id") != F.col("b_id")).drop("pa")
    only_hot = by_pattern.join(pairs.select("a_id", "b_id"), ["a_id", "b_id"], "left_anti")
    return top_n_per_key(first.drop("rank").unionByName(only_hot), ["a_id"], [*of_columns("a"), *tie], k)
