"""Array-vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.scalars import col_of


def as_doubles(v: Column | str) -> Column:
    return col_of(v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalise(v: Column | str) -> Column:
    """Unit length; a zero vector stays zero."""
    n = norm(v)
    return F.transform(as_doubles(v), lambda x: x / F.when(n == 0, F.lit(1.0)).otherwise(n))


def scaled(v: Column | str, w: float) -> Column:
    return F.transform(as_doubles(v), lambda x: x * F.lit(w))


def padded(v: Column | str, width: int) -> Column:
    """Zero-padded or cut to `width` entries."""
    zeros = F.array_repeat(F.lit(0.0), width)
    return F.slice(F.concat(as_doubles(v), zeros), 1, width)
