"""Column profiles and data-quality checks over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.scalars import ellipsis, r6
from opinara.operators.toprows import top_n_per_key

ISSUE_NULL_RATE = 0.5
WARNING_NULL_RATE = 0.1


def _length(field: T.StructField):
    c = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.length(c)
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return F.size(c)
    return F.lit(None).cast("int")


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: type, nulls, distinct values, numeric range, lengths.

    Two passes: one wide aggregate for everything but distinct counts, which are
    counted per (column, value) pair when `exact` and sketched otherwise.
    """
    n = len(df.columns)
    parts = []
    for f in df.schema.fields:
        c = F.col(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        number = c.cast("double") if numeric else F.lit(None).cast("double")
        length = _length(f)
        parts.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(c.isNull()).alias("null_count"),
                F.count_if(c == "").alias("empty_count") if isinstance(f.dataType, T.StringType) else F.lit(0).cast("long").alias("empty_count"),
                F.approx_count_distinct(c.cast("string")).alias("approx_unique"),
                F.min(number).alias("min_value"),
                F.max(number).alias("max_value"),
                F.min(length).alias("min_length"),
                F.max(length).alias("max_length"),
                r6(F.avg(length)).alias("avg_length"),
            )
        )
    wide = df.agg(F.array(*parts).alias("p")).select(F.inline("p"))
    wide = wide.withColumn("nullable", F.col("null_count") > 0)
    wide = wide.withColumn("null_rate", r6(F.when(F.col("n_rows") > 0, F.col("null_count") / F.col("n_rows")).otherwise(0.0)))
    if not exact:
        return wide.withColumnRenamed("approx_unique", "unique_count")
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])
    values = df.select(F.inline(entries)).filter(F.col("value").isNotNull())
    unique = values.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("unique_count"))
    # The right side has one row per column of the table.
    return wide.drop("approx_unique").join(F.broadcast(unique), "column_name", "left").withColumn(
        "unique_count", F.coalesce("unique_count", F.lit(0))
    )


def sample_values(df: DataFrame, n: int = 5, width: int = 100) -> DataFrame:
    """The `n` lowest distinct non-null values of each column as text, each shortened to `width` characters."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])
    values = df.select(F.inline(entries)).filter(F.col("value").isNotNull()).distinct()
    lowest = top_n_per_key(values, ["column_name"], [F.asc("value")], n, "_r")
    picked = lowest.groupBy("column_name").agg(F.array_sort(F.collect_list("value")).alias("v"))
    return picked.select("column_name", F.transform("v", lambda v: ellipsis(v, width)).alias("sample_values"))


def data_dictionary(df: DataFrame) -> DataFrame:
    """Readable field list: type, nullable, unique values, range and three samples."""
    samples = sample_values(df, 3)
    profile = column_profile(df)
    return profile.join(F.broadcast(samples), "column_name", "left").select(
        F.col("column_name").alias("field_name"),
        "data_type",
        "nullable",
        F.col("unique_count").alias("unique_values"),
        F.col("min_value").alias("min"),
        F.col("max_value").alias("max"),
        F.array_join("sample_values", "; ").alias("sample_values"),
    )


def json_field_profile(df: DataFrame, column: str) -> DataFrame:
    """Profile of the fields inside a JSON text column whose schema is not known.

    Types are counted per field; the most frequent non-null one is the field's type.
    """
    spark = df.sparkSession
    parsed = df.select(F.try_parse_json(F.col(column)).alias("_v")).filter(F.col("_v").isNotNull())
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(
        F.col("key").alias("field"),
        F.schema_of_variant("value").alias("type"),
        F.col("value").cast("string").alias("text"),
        F.when(F.schema_of_variant("value").rlike("BIGINT|DOUBLE|DECIMAL"), F.try_variant_get("value", "$", "double")).alias("number"),
    )
    is_null = F.col("type") == "VOID"
    by_type = fields.groupBy("field", "type").agg(
        F.count(F.lit(1)).alias("n"), F.min("number").alias("lo"), F.max("number").alias("hi"),
        F.max(F.length("text")).alias("len"),
    )
    unique = fields.filter(~is_null).select("field", "text").distinct().groupBy("field").agg(F.count(F.lit(1)).alias("unique_count"))
    rank = F.struct(~is_null, F.col("n"), F.col("type"))
    per_field = by_type.groupBy("field").agg(
        F.max_by("type", rank).alias("data_type"),
        F.sum("n").alias("n_rows"),
        F.sum(F.when(is_null, F.col("n")).otherwise(0)).alias("null_count"),
        F.min("lo").alias("min_value"),
        F.max("hi").alias("max_value"),
        F.max("len").alias("max_length"),
    )
    return per_field.join(unique, "field", "left").withColumn("unique_count", F.coalesce("unique_count", F.lit(0)))


def missing_rates(df: DataFrame) -> DataFrame:
    """Share of NULLs, empty texts and zeros per column, in percent."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f.name)
        empty = (c == "") if isinstance(f.dataType, T.StringType) else F.lit(False)
        zero = (c == 0) if isinstance(f.dataType, T.NumericType) else F.lit(False)
        parts.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.count_if(c.isNull()).alias("missing"),
            r6(F.avg(c.isNull().cast("double")) * 100).alias("missing_pct"),
            F.count_if(empty).alias("empty"),
            F.count_if(zero).alias("zero"),
            r6(F.coalesce(F.avg(F.coalesce(zero, F.lit(False)).cast("double")), F.lit(0.0)) * 100).alias("zero_pct"),
        ))
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def quality_findings(df: DataFrame, id_columns: list[str]) -> DataFrame:
    """One row per finding: `check_name`, `column_name`, `severity`, `amount`.

    NULL rates above 50 % are issues and above 10 % warnings; empty texts and
    repeated id keys are warnings.
    """
    profile = column_profile(df, exact=False)
    nulls = profile.filter(F.col("null_rate") > WARNING_NULL_RATE).select(
        F.lit("null_rate").alias("check_name"),
        "column_name",
        F.when(F.col("null_rate") > ISSUE_NULL_RATE, "issue").otherwise("warning").alias("severity"),
        F.col("null_rate").alias("amount"),
    )
    empties = profile.filter(F.col("empty_count") > 0).select(
        F.lit("empty_text").alias("check_name"), "column_name", F.lit("warning").alias("severity"),
        F.col("empty_count").cast("double").alias("amount"),
    )
    copies = df.groupBy(*id_columns).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys")
    )
    repeated = copies.filter(F.col("rows") > F.col("keys")).select(
        F.lit("duplicate_rate").alias("check_name"), F.lit(",".join(id_columns)).alias("column_name"),
        F.lit("warning").alias("severity"), r6((F.col("rows") - F.col("keys")) / F.col("rows")).alias("amount"),
    )
    return reduce(DataFrame.unionByName, [nulls, empties, repeated])


def quality_report(df: DataFrame, id_columns: list[str]) -> DataFrame:
    """One row: record count, number of issues and warnings, `is_valid`."""
    found = quality_findings(df, id_columns).agg(
        F.count_if(F.col("severity") == "issue").alias("n_issues"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
        F.array_sort(F.collect_list(F.struct("severity", "check_name", "column_name", "amount"))).alias("findings"),
    )
    total = df.agg(F.count(F.lit(1)).alias("total_records"))
    return found.select(
        total.scalar().alias("total_records"), "n_issues", "n_warnings",
        (F.col("n_issues") == 0).alias("is_valid"), "findings",
    )
