"""Small helpers of this package."""

from __future__ import annotations

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` plus `columns`; a column of the input that has one of the new names is replaced."""
    taken = {c.lower() for c in columns}
    kept = [F.col(f"`{c}`") for c in dict.fromkeys(df.columns) if c.lower() not in taken]
    return df.select(*kept, *(v.alias(k) for k, v in columns.items()))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or the first of it with underscores added that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast `value` with the classes it uses, so that executors need no copy of this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared_value(shared: Broadcast):
    return cloudpickle.loads(shared.value)


def learned(key: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text, modulo `modulus`, equals `remainder`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus == remainder
