"""Term features: relational TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.text import bigrams, tokens, without_stop_words
from opinara.session import materialise, spread


def doc_terms(docs: DataFrame, id_col: str, text_col: str, ngrams: bool = True, stop_words: bool = True) -> DataFrame:
    """(`doc`, `terms`): words and, after stop words are gone, neighbouring word pairs."""
    words = tokens(F.coalesce(F.col(text_col), F.lit("")))
    base = spread(docs.select(F.col(id_col).alias("doc"), F.col(text_col))).select("doc", words.alias("_w"))
    if stop_words:
        base = base.withColumn("_w", without_stop_words(F.col("_w")))
    return base.select("doc", (F.concat("_w", bigrams(F.col("_w"))) if ngrams else F.col("_w")).alias("terms"))


def vocabulary(terms: DataFrame, n_docs, min_df: int = 2, max_df: float = 0.8, max_features: int | None = None) -> DataFrame:
    """(`term`, `df`, `total`) within the document-frequency limits, the most frequent terms kept.

    Every document sorts its own terms and marks the first of each, so one
    grouping by term counts documents and occurrences; no (document, term) shuffle.
    """
    ordered = terms.select(F.array_sort("terms").alias("t"))
    marked = F.transform("t", lambda x, i: F.struct(
        x.alias("term"), F.when((i == 0) | (F.get("t", i - 1) != x), 1).otherwise(0).alias("first")
    ))
    v = ordered.select(F.inline(marked)).groupBy("term").agg(F.sum("first").alias("df"), F.count(F.lit(1)).alias("total"))
    v = v.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    return v if max_features is None else v.orderBy(F.desc("total"), F.asc("term")).limit(max_features)


def tfidf(docs: DataFrame, id_col: str, text_col: str, *, ngrams: bool = True, stop_words: bool = True, min_df: int = 2,
          max_df: float = 0.8, max_features: int | None = None) -> DataFrame:
    """(`doc`, `term`, `tf`, `df`, `weight`), unit length per document.

    weight = tf * (ln((1 + n) / (1 + df)) + 1), so a term of every document keeps some weight.
    """
    terms = materialise(doc_terms(docs, id_col, text_col, ngrams, stop_words))
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    vocab = materialise(vocabulary(terms, n, min_df, max_df, max_features).select("term", "df"))
    if max_features is not None:
        vocab = F.broadcast(vocab)  # at most max_features rows
    kept = terms.select("doc", F.explode("terms").alias("term")).join(vocab, "term")
    counts = kept.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("df").alias("df"))
    w = F.col("tf") * (F.ln((1 + n).cast("double") / (1 + F.col("df"))) + 1)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    return counts.withColumn("w", w).withColumn("norm", norm).select(
        "doc", "term", "tf", "df", F.when(F.col("norm") > 0, F.col("w") / F.col("norm")).otherwise(0.0).alias("weight")
    )
