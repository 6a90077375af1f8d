"""Readers for raw review and product records in JSON lines, plain or gzip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType([
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("images", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("asin", T.StringType()),
    T.StructField("parent_asin", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("helpful_vote", T.IntegerType()),
    T.StructField("verified_purchase", T.BooleanType()),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("parent_asin", T.StringType()),
    T.StructField("main_category", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("average_rating", T.DoubleType()),
    T.StructField("rating_number", T.IntegerType()),
    T.StructField("price", T.StringType()),
    T.StructField("store", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("description", T.ArrayType(T.StringType())),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("images", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("videos", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    T.StructField("bought_together", T.ArrayType(T.StringType())),
])

BAD = "_bad"


def parse_lines(lines: DataFrame, schema: T.StructType, on_bad_line: str = "skip") -> DataFrame:
    """Records of a one-column (`value`) table of JSON lines; blank lines are left out.

    `on_bad_line`: "skip" drops unreadable lines, "keep" leaves their text in `_bad`.
    Lines are parsed by expression: the JSON reader refuses plans that only look at `_bad`.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    out = lines.filter(F.trim("value") != "").select(F.from_json("value", with_bad, options).alias("r")).select("r.*")
    if on_bad_line == "skip":
        return out.filter(F.col(BAD).isNull()).drop(BAD)
    if on_bad_line != "keep":
        raise ValueError(f"unknown on_bad_line {on_bad_line!r}")
    return out


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, on_bad_line: str = "skip", limit: int | None = None,
               partitions: int | None = None) -> DataFrame:
    """Records of JSON lines; one file or a folder of files.

    `on_bad_line`: "skip" drops unreadable lines, "fail" stops the job (`require_valid`
    says where), "keep" leaves their text in `_bad`. `limit` reads only so many lines, bad ones
    included. A gzip file is one task; pass `partitions` to spread its rows.
    """
    if on_bad_line == "fail":
        out = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        out = out.limit(limit) if limit is not None else out
    else:
        lines = spark.read.text(path).filter(F.trim("value") != "")
        out = parse_lines(lines.limit(limit) if limit is not None else lines, schema, on_bad_line)
    return out.repartition(partitions) if partitions else out


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(`value`, `file`, `line`): every line with its file and its number there, from 1.

    No file is read by one task: a line's place within its split comes from the task, and the
    lines of earlier splits are counted once, one row for each split. Both scans have to cut the
    files alike, so the files must not change in between. Blank lines count.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    splits = splits.select("file", "start", (F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("shift"))
    return lines.join(splits, ["file", "start"]).select("value", "file", (F.col("at") - F.col("shift") + 1).alias("line"))


def bad_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(`file`, `line`, `_bad`): the lines that cannot be read, blank ones aside."""
    with_bad = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    out = numbered_lines(spark, path).filter(F.trim("value") != "").select("file", "line", parsed[BAD].alias(BAD))
    return out.filter(F.col(BAD).isNotNull())


def require_valid(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Raise a ValueError that names file and line of the first unreadable line, if there is one."""
    first = bad_lines(spark, path, schema).orderBy("file", "line").limit(1).collect()
    if first:
        raise ValueError(f"{first[0]['file']}, line {first[0]['line']}: {first[0][BAD][:200]!r} is no record of the schema")


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path, size in MB and modification time of the files behind `path`."""
    files = spark.read.text(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return files.distinct().withColumn("file_size_mb", F.col("file_size") / (1024 * 1024))
