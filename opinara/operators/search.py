"""Keyword search over text columns, ranked by BM25."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import stem, tokens
from opinara.operators.toprows import top_n_per_key
from opinara.session import materialise, spread

K1, B = 1.2, 0.75


def field_search(docs: DataFrame, id_col: str, fields: dict[str, float], queries: dict[str, str], mode: str = "all", limit: int = 20,
                 stems: bool = True) -> DataFrame:
    """Best `limit` documents per query over several weighted columns: `query_id`, `doc`, `score`, `rank`.

    `fields` maps text columns to weights. A word counts in each column by its weight and by
    the column's length against its mean, the counts are added up, and BM25 is taken once of
    the sum. `mode` is "all" (every query word in some column) or "any". With `stems` words
    meet by their stem. Each document keeps only its query words before anything is exploded,
    and only words that can have a typed word's stem are stemmed, so the shuffle carries
    matches and not the whole vocabulary. Null columns count as empty.
    """
    if mode not in ("all", "any"):
        raise ValueError(f"unknown mode {mode!r}")
    if not fields or min(fields.values()) <= 0:
        raise ValueError("fields need weights above 0")
    spark = docs.sparkSession
    typed = tokens("q")
    asked = spark.createDataFrame(list(queries.items()), "query_id string, q string").select(
        "query_id", F.explode(F.array_distinct(F.transform(typed, stem) if stems else typed)).alias("term")
    )
    terms = [r["term"] for r in asked.select("term").distinct().collect()]  # the words the caller typed
    begins = "^(?:" + "|".join(sorted({t[:-1] for t in terms})) + ")"  # letters, digits and underscores only

    def matches(words: Column) -> Column:
        if stems:
            words = F.transform(F.filter(words, lambda w: w.rlike(begins)), stem)
        return F.filter(words, lambda w: w.isin(*terms))

    # Tokenised once: lengths and query words of every document, all small.
    base = spread(docs.select(F.col(id_col).alias("doc"), *(F.coalesce(F.col(c), F.lit("")).alias(f"f{i}") for i, c in enumerate(fields))))
    at = range(len(fields))
    seen = materialise(base.select("doc", *(tokens(F.col(f"f{i}")).alias(f"w{i}") for i in at)).select(
        "doc", *(F.size(f"w{i}").alias(f"len{i}") for i in at), *(matches(F.col(f"w{i}")).alias(f"m{i}") for i in at)))
    stats = seen.agg(F.count(F.lit(1)).alias("n"), *(F.avg(f"len{i}").alias(f"a{i}") for i in at)).first()

    def counted(i: int, weight: float) -> Column:
        each = F.lit(float(weight)) / (1 - B + F.lit(B) * F.col(f"len{i}") / F.lit(stats[f"a{i}"] or 1.0))
        return F.transform(f"m{i}", lambda t: F.struct(t.alias("term"), each.alias("tf")))

    hits = (
        seen.select("doc", F.inline(F.concat(*(counted(i, w) for i, w in enumerate(fields.values())))))
        .groupBy("doc", "term").agg(F.sum("tf").alias("tf"))
    )
    df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    wanted = asked.join(asked.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms")), "query_id")
    per_term = F.broadcast(wanted.join(df, "term"))  # one row per typed word
    idf = F.ln(1 + (stats["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    scored = hits.join(per_term, "term").groupBy("query_id", "doc").agg(
        F.round(F.sum(idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1)), 9).alias("score"),
        F.count(F.lit(1)).alias("matched"), F.first("n_terms").alias("n_terms")
    )
    if mode == "all":
        scored = scored.filter(F.col("matched") == F.col("n_terms"))
    return top_n_per_key(scored, ["query_id"], [F.desc("score"), F.asc("doc")], limit).select("query_id", "doc", "score", "rank")


def keyword_search(docs: DataFrame, id_col: str, text_col: str, queries: dict[str, str], mode: str = "all", limit: int = 20) -> DataFrame:
    """`field_search` over one column, by whole words."""
    return field_search(docs, id_col, {text_col: 1.0}, queries, mode, limit, stems=False)


def contains_search(docs: DataFrame, id_col: str, columns: list[str], keyword: str, limit: int = 20) -> DataFrame:
    """Unranked case-sensitive substring search; the lowest ids are returned."""
    from opinara.operators.eda import contains_text

    return contains_text(docs, keyword, columns).orderBy(id_col).limit(limit)
