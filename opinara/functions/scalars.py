"""Scalar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_epoch_ms(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp; a missing value counts as 0."""
    return F.timestamp_millis(F.coalesce(col_of(ms), F.lit(0)).cast("long"))


def parse_price(price: Column | str) -> Column:
    """Number left after dropping all but digits and dots; NULL if that is no number.

    A range such as "$10 - $20" becomes 1020.0 by this rule; see `price_is_suspect`.
    """
    return F.regexp_replace(col_of(price).cast("string"), r"[^0-9.]", "").try_cast("double")


def price_is_suspect(price: Column | str) -> Column:
    """True for strings that hold more than one number."""
    return F.coalesce(col_of(price).cast("string").rlike(r"[0-9][^0-9]*\s-\s*[^0-9]*[0-9]"), F.lit(False))


def to_number(value: Column | str) -> Column:
    """Lenient cast: NULL where the text is no number."""
    return col_of(value).try_cast("double")


def list_not_empty(values: Column | str) -> Column:
    return F.coalesce(F.size(col_of(values)) > 0, F.lit(False))


def has_real_item(values: Column | str) -> Column:
    """True when a list holds an entry other than '', 'nan' or 'None'."""
    blank = ("", "nan", "None")
    return F.coalesce(
        F.exists(col_of(values), lambda v: v.isNotNull() & ~v.isin(*blank)), F.lit(False)
    )


def join_list(values: Column | str, sep: str = " ") -> Column:
    return F.coalesce(F.array_join(col_of(values), sep), F.lit(""))


def composite_key(*parts: Column | str) -> Column:
    return F.concat_ws("_", *[col_of(p).cast("string") for p in parts])


def surrogate_key(*parts: Column | str) -> Column:
    """64-bit row id from key columns, stable between runs."""
    return F.xxhash64(*[col_of(p) for p in parts])


def ellipsis(text: Column | str, width: int) -> Column:
    text = col_of(text)
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def score_cell(title: Column | str, score: Column | str, width: int = 35) -> Column:
    """`title (0.83)`; an em dash where there is no title."""
    cell = F.format_string("%s (%.2f)", ellipsis(title, width), col_of(score))
    return F.when(col_of(title).isNull(), F.lit("—")).otherwise(cell)


def percent(part: Column | str, total: Column | str) -> Column:
    part, total = col_of(part), col_of(total)
    return F.when(total > 0, part.cast("double") / total * 100).otherwise(F.lit(0.0))


def nan_to_null(value: Column | str) -> Column:
    """NaN and infinities become NULL."""
    value = col_of(value)
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def iso_timestamp(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def month_name(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "MMM")


def hash_bucket(text: Column | str, buckets: int = 100) -> Column:
    """Category code in [0, 1), the same in every process."""
    return F.pmod(F.xxhash64(col_of(text)), F.lit(buckets)).cast("double") / buckets


def md5_bucket(text: Column | str, buckets: int = 100) -> Column:
    """As `hash_bucket`, from md5 so that other engines can repeat it."""
    head = F.substring(F.md5(col_of(text).cast("string")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(buckets)).cast("double") / buckets


def capped_ratio(n: Column | str, cap: int = 1000) -> Column:
    return F.least(F.coalesce(col_of(n), F.lit(0)), F.lit(cap)).cast("double") / cap


def distance_to_similarity(d: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + col_of(d))


def cosine_to_unit(s: Column | str) -> Column:
    return (col_of(s) + 1) / 2


def r6(value: Column | str) -> Column:
    return F.round(col_of(value).cast("double"), 6)


def fixed(value: Column | str, digits: int = 9) -> Column:
    """Non-negative value to `digits` decimals, halves up; compiles, unlike `round` on doubles."""
    unit = float(10 ** digits)
    return F.floor(col_of(value) * unit + 0.5) / unit
