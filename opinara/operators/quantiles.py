"""Exact quantiles of large columns, and histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import materialise


def exact_quantiles(df: DataFrame, value: Column, points: list[float]) -> list[float | None]:
    """Linear-interpolated quantiles of a numeric column; NULL and NaN are left out.

    Equal values combine first; the distinct values are range-partitioned and
    only the ranges that hold a wanted position are sorted. No task sees the
    whole column.
    """
    counts = df.select(value.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = counts.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ranged = materialise(counts.repartitionByRange("v").withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.sum("n").alias("n")).orderBy("_range").collect()  # one row per partition
    total = sum(r["n"] for r in sizes)
    if total == 0:
        return [None for _ in points]
    wanted = {}
    for p in points:
        at = p * (total - 1)
        wanted[p] = (math.floor(at), math.ceil(at), at - math.floor(at))
    positions = sorted({i for lo, hi, _ in wanted.values() for i in (lo, hi)})
    starts, before = {}, 0
    for r in sizes:
        if any(before <= i < before + r["n"] for i in positions):
            starts[r["_range"]] = before
        before += r["n"]
    w = Window.partitionBy("_range").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.create_map(*[F.lit(x) for kv in starts.items() for x in kv])
    placed = (
        ranged.filter(F.col("_range").isin(list(starts)))
        .withColumn("last", F.sum("n").over(w) + F.element_at(first, F.col("_range")) - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    hit = F.lit(False)
    for i in positions:
        hit = hit | ((F.col("first") <= i) & (F.col("last") >= i))
    rows = placed.filter(hit).select("v", "first", "last").collect()  # at most two rows per point
    at = {i: next(r["v"] for r in rows if r["first"] <= i <= r["last"]) for i in positions}
    return [at[lo] + (at[hi] - at[lo]) * frac for lo, hi, frac in (wanted[p] for p in points)]


def below_quantile(df: DataFrame, column: str, p: float = 0.95) -> DataFrame:
    """Rows strictly below the `p` quantile of a column."""
    (cut,) = exact_quantiles(df, F.col(column), [p])
    return df.filter(F.lit(False)) if cut is None else df.filter(F.col(column) < cut)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the column's min and max, empty bins included.

    The last bin is closed on the right.
    """
    v = F.col(column).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, n long")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    which = F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(v.isNotNull()).groupBy(which.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
