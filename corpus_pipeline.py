"""A training-data pipeline over `documents`: language, near duplicates, benchmark leaks, mix, shards.

Each stage is written as Parquet in the shared folder and read again by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import decontaminate, langid, mixing, ngram_join, sharding
from opinara.llm.common import fresh
from opinara.session import materialise

SHARDS = 40
MIN_LANGUAGE_SCORE = 0.05

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts that resemble no learned language; `lang` becomes the predicted one."""
    found = langid.identify(docs, langid.fit(docs, learn=F.lit(True)))
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near duplicates."""
    return ngram_join.keep_one(docs, threshold=0.8, n=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix sources to their weights: a document is repeated as often as the mix takes all of it, and once more for a taken part.

    A part of a document's words is taken only where a source's words end inside it.
    """
    taken, _ = mixing.mix_sources(docs)
    i, source, size, times = (fresh(docs, c) for c in ("mix_id", "mix_source", "mix_size", "mix_times"))
    often = taken.filter("taken > 0").groupBy(F.col("doc_id").alias(i), F.col("source").alias(source), F.col("size").alias(size)) \
        .agg(F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias(times))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(i)) & docs["source"].cast("string").eqNullSafe(F.col(source)) & (mixing.word_count() == F.col(size))
    return docs.join(often, same).select(*docs.columns, F.explode(F.sequence(F.lit(1), times)).alias(times)).drop(times)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the mix into shards of equal bytes; adds size, shard and slot."""
    return sharding.shard_by_bytes(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mix", mix_sources),
    ("shard", shard),
]

# Hyperdimensional cosines, edit distances to windows and the cut into shards have no SQL form; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the `documents` table of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
