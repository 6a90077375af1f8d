"""Top rows, samples and global positions without single-task sorts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import materialise


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first `n` rows of each key.

    The planner limits each key inside every map task before the shuffle
    (WindowGroupLimit), so a hot key sends at most `n` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First `n` rows of the whole table (per-task heaps, then one merge)."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """`n` rows without replacement, the same however the table is partitioned."""
    ticket = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.orderBy(ticket, F.col(id_col)).limit(n)


def rows_of_sampled_keys(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of `n` sampled distinct keys."""
    keys = seeded_sample(df.select(id_col).distinct(), id_col, n, seed)
    return df.join(keys, id_col, "left_semi")


def row_at_position(keys: DataFrame, order: list[str], position: Callable[[int], int]):
    """The row at a 0-based position of the global order, or None past the end.

    `position` receives the number of rows.
    Rows are range-partitioned on the order columns, counted per range, and only
    the range that holds the position is sorted. Pass key columns only.
    """
    ranged = materialise(keys.select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").count().orderBy("_range").collect()  # one row per partition
    position = position(sum(row["count"] for row in counts))
    before = 0
    for row in counts:
        if position < before + row["count"]:
            w = Window.partitionBy("_range").orderBy(*order)
            hit = ranged.filter(F.col("_range") == row["_range"]).withColumn("_n", F.row_number().over(w))
            return hit.filter(F.col("_n") == position - before + 1).select(*order).first()
        before += row["count"]
    return None


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Dense 0-based position of every row in the global order of `order`."""
    ranged = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").count().orderBy("_range").collect()  # one row per partition
    starts, before = [], 0
    for row in counts:
        starts.append((row["_range"], before))
        before += row["count"]
    if not starts:
        return ranged.withColumn(name, F.lit(None).cast("long")).drop("_range")
    offsets = F.create_map(*[F.lit(x) for pair in starts for x in pair])
    w = Window.partitionBy("_range").orderBy(*order)
    place = F.row_number().over(w) - 1 + F.element_at(offsets, F.col("_range"))
    return ranged.withColumn(name, place.cast("long")).drop("_range")


def before_row(row, order: list[str]) -> Column:
    """Condition: the row sorts strictly before `row` on the order columns."""
    cond, tied = F.lit(False), F.lit(True)
    for c in order:
        cond = cond | (tied & (F.col(c) < F.lit(row[c])))
        tied = tied & (F.col(c) == F.lit(row[c]))
    return cond


def temporal_part(reviews: DataFrame, order: list[str], test_size: float = 0.2, name: str = "part") -> DataFrame:
    """`reviews` with `name`: "train" for the oldest `int(n * (1 - test_size))` rows, "test" for the rest.

    Only the key columns are sorted to find the first test row; the wide rows are
    then labelled in place, in one pass.
    """
    cut = row_at_position(reviews, order, lambda n: int(n * (1 - test_size)))
    label = F.lit("train") if cut is None else F.when(before_row(cut, order), "train").otherwise("test")
    return reviews.withColumn(name, label)


def temporal_split(reviews: DataFrame, order: list[str], test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """The two parts of `temporal_part` as tables of their own."""
    parts = temporal_part(reviews, order, test_size, "_part")
    return tuple(parts.filter(F.col("_part") == p).drop("_part") for p in ("train", "test"))


def hot_keys(df: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """Key values with more than `limit` rows, or None when there are none."""
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select(*keys)
    return None if hot.isEmpty() else materialise(hot)


def user_halves(reviews: DataFrame, order: list[str], user: str = "user_id", hot_limit: int = 1_000_000) -> DataFrame:
    """Mark each review as in the later half of its user's time order.

    `position` counts from 0; rows from `n // 2` on are `is_later_half`. Users
    with more than `hot_limit` reviews are placed by a range-partitioned global
    sort, so no task has to hold one user's whole history.
    """
    hot = hot_keys(reviews, [user], hot_limit)
    w = Window.partitionBy(user)

    def windowed(df: DataFrame) -> DataFrame:
        return df.withColumn("position", (F.row_number().over(w.orderBy(*order)) - 1).cast("long")).withColumn(
            "n_reviews", F.count(F.lit(1)).over(w)
        )

    if hot is None:
        placed = windowed(reviews)
    else:
        ranged = with_position(reviews.join(hot, user, "left_semi"), [user, *order], "_at")
        starts = ranged.groupBy(user).agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("n_reviews"))
        large = ranged.join(starts, user).withColumn("position", F.col("_at") - F.col("_start"))
        placed = windowed(reviews.join(hot, user, "left_anti")).unionByName(large.drop("_at", "_start"))
    return placed.withColumn("is_later_half", F.col("position") >= F.floor(F.col("n_reviews") / 2))
