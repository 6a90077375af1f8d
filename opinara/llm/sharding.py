"""Shards of nearly equal bytes by histogram sort.

Rows are put in the order of a key (text digest, doc_id, tie-breaker), so equal texts are
neighbours. The boundaries between shards are found without sorting: a round counts the
bytes and rows between candidate keys, and the extreme keys, in every partition of a slim
key table; each boundary keeps the interval that holds its target and gets new candidates
inside. When every boundary meets the tolerance, rows are exchanged once.

The tie-breaker lets even a key that a third of all rows repeat be cut inside.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import fresh, with_columns
from opinara.session import materialise

KEY_BYTES = 24
KEYS = 1 << (8 * KEY_BYTES)
PART_ROWS, PART_BYTES = 1_000_000, 256 << 20  # what one task sorts while slots are numbered
LOOSE = 0.25  # tolerance of boundaries that only part the work, in parts


class Boundary(NamedTuple):
    key: bytes  # rows with this key or a larger one lie behind the boundary
    size: int  # bytes before it
    rows: int  # rows before it


def _key(x: int) -> bytes:
    return min(x, KEYS - 1).to_bytes(KEY_BYTES, "big")


def _eight(x: Column) -> Column:
    """A long as 8 bytes that sort as it does."""
    return F.unhex(F.lpad(F.hex(x.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def key_column(text: str = "text", doc_id: str = "doc_id") -> Column:
    digest = F.unhex(F.substring(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), 1, 16))
    tie = F.xxhash64(F.monotonically_increasing_id())
    return F.concat(digest, _eight(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))), _eight(tie))


def size_column(text: str = "text", extra: int = 16) -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(extra)).cast("long")


def _count(probes: list[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array(probes, f"S{KEY_BYTES}")
        size, rows, low, high = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64), {}, {}
        for b in batches:
            keys = np.array(b.column(0).to_pylist(), f"S{KEY_BYTES}")
            order = np.argsort(keys)
            keys, sizes = keys[order], np.asarray(b.column(1))[order]
            cuts = np.concatenate([[0], np.searchsorted(keys, at), [len(keys)]])
            total = np.concatenate([[0], np.cumsum(sizes)])
            size += total[cuts[1:]] - total[cuts[:-1]]
            rows += np.diff(cuts)
            for i in np.flatnonzero(np.diff(cuts)):
                a, z = keys[cuts[i]], keys[cuts[i + 1] - 1]
                low[i], high[i] = min(low.get(i, a), a), max(high.get(i, z), z)
        full = np.flatnonzero(rows)
        pad = lambda x: bytes(x).ljust(KEY_BYTES, b"\0")  # noqa: E731  numpy drops trailing zeros
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(size[full]), pa.array(rows[full]), pa.array([pad(low[i]) for i in full], pa.binary()), pa.array([pad(high[i]) for i in full], pa.binary())],
            names=["bin", "size", "n", "low", "high"])

    return count


def splitters(keys: DataFrame, parts: int, tolerance: float = 0.0, probes: int = 16, every: int = 1) -> list[Boundary]:
    """Boundaries 1 to `parts` - 1 over `keys` (key binary, size long).

    Boundary i is the first key that has at least i / `parts` of all bytes before it, or one
    whose bytes exceed that by at most `tolerance` of a part; boundaries whose number `every`
    does not divide may exceed it by `LOOSE` of a part at least, so they are done after a round
    or two. The bytes and rows before a boundary are exact for all. The driver holds `probes`
    keys for each boundary that is still open, and finds each boundary's place by bisection.
    """
    def histogram(at: list[int]) -> list[tuple]:
        rows = keys.select("key", "size").mapInArrow(_count([_key(x) for x in at]), "bin int, size bigint, n bigint, low binary, high binary") \
            .groupBy("bin").agg(F.sum("size"), F.sum("n"), F.min("low"), F.max("high")).collect()
        return sorted((r[0], r[1], r[2], int.from_bytes(r[3], "big"), int.from_bytes(r[4], "big") + 1) for r in rows)

    whole = histogram([])
    if not whole:
        return [Boundary(_key(KEYS), 0, 0)] * (parts - 1)
    _, total, n, low, high = whole[0]
    state = [(low, 0, 0, high, total, n)] * (parts - 1)

    def open_(i: int) -> bool:
        a, _, rows_a, b, size_b, rows_b = state[i]
        allowed = tolerance if (i + 1) % every == 0 else max(tolerance, LOOSE)
        return rows_b - rows_a > 1 and b - a > 1 and size_b * parts - (i + 1) * total > allowed * total

    while any(open_(i) for i in range(parts - 1)):
        spans = {state[i][0:1] + state[i][3:4] for i in range(parts - 1) if open_(i)}
        at = sorted({a + (b - a) * j // (probes + 1) for a, b in spans for j in range(1, probes + 1)} - {a for a, _ in spans})
        found, size, rows = [], 0, 0
        for k, s, m, first, end in histogram(at):
            found += [(first, size, rows), (end, size + s, rows + m)]  # bytes and rows below the extreme keys of a bin
            size, rows = size + s, rows + m
        before = [s for _, s, _ in found]  # ascending, as are the keys
        for i in range(parts - 1):
            a, size_a, rows_a, b, size_b, rows_b = state[i]
            at = bisect_left(before, -(-(i + 1) * total // parts))
            if at > 0 and (found[at - 1][1], found[at - 1][0]) > (size_a, a):
                a, size_a, rows_a = found[at - 1]
            if at < len(found) and (found[at][1], found[at][0]) < (size_b, b):
                b, size_b, rows_b = found[at]
            state[i] = (a, size_a, rows_a, b, size_b, rows_b)
    return [Boundary(_key(b), s, m) for _, _, _, b, s, m in state]


def shard_by_bytes(docs: DataFrame, shards: int, tolerance: float = 0.0, text: str = "text", doc_id: str = "doc_id", probes: int = 16, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """All rows and columns of `docs` plus size, shard (0 to `shards` - 1) and slot (its place in the shard, from 0).

    `size` is the UTF-8 bytes of the text plus 16. With `tolerance` 0 a shard's bytes are
    within one row of the mean, else within that share of it. Null texts have size 16 and sort
    with empty ones; a null doc_id sorts first; repeated rows may fall on either side of a
    boundary; an empty table gives an empty result; input columns of the new names are replaced.
    """
    key, part = fresh(docs, "sort_key"), fresh(docs, "part")
    docs = with_columns(docs, **{"size": size_column(text), key: key_column(text, doc_id)})
    slim = materialise(docs.select(F.col(key).alias("key"), "size"))
    rows, total = slim.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = shards * max(1, -(-rows // (shards * part_rows)), -(-total // (shards * part_bytes)))
    each = parts // shards
    cuts = splitters(slim, parts, tolerance, probes, each)
    keys = [c.key for c in cuts]
    starts = np.array([0, *(c.rows for c in cuts)], np.int64)
    shifts = starts - starts[np.arange(parts) // each * each]  # rows of the shard before a part

    @F.pandas_udf("part int, shift bigint")
    def place(key: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(np.array(keys, f"S{KEY_BYTES}"), np.array(key.tolist(), f"S{KEY_BYTES}"), "right")
        return pd.DataFrame({"part": at.astype(np.int32), "shift": shifts[at]})

    number, shift = F.col(part)["part"], F.col(part)["shift"]
    slot = F.row_number().over(Window.partitionBy(number).orderBy(key)).cast("long") - 1 + shift
    placed = docs.withColumn(part, place(key))
    return with_columns(placed, shard=F.floor(number / each).cast("int"), slot=slot).drop(part, key)
