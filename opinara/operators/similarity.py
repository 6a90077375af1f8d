"""Similar products and users by feature kind, and method comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.scalars import ellipsis, fixed, score_cell
from opinara.functions.text import tokens
from opinara.operators.partners import HOT_LIMIT, fixed_of, top_partners
from opinara.operators.scores import copy_classes, expand_classes, top_scores
from opinara.operators.toprows import top_n_per_key
from opinara.session import materialise


def similar_by_terms(features: DataFrame, k: int = 10, hot_limit: int = 10_000) -> DataFrame:
    """Best `k` other documents by cosine of unit-length term vectors.

    features: (doc, term, weight). Documents with equal vectors are searched
    once: classes are compared with classes and then opened up again.
    Output: `query_id`, `neighbour_id`, `similarity`, `rank`.
    """
    vectors = materialise(features.select(F.col("doc").alias("item"), F.col("term").alias("dim"), F.col("weight").alias("iw")))
    members = materialise(copy_classes(vectors))
    heads = materialise(vectors.join(members.filter(F.col("place") == 0), "item", "left_semi"))
    queries = heads.select(F.col("item").alias("query"), "dim", F.col("iw").alias("qw"))
    ranked = top_scores(queries, heads, k + 1, None, hot_limit).select("query", F.col("item").alias("class"), "score")
    return for_members(expand_classes(ranked, members, k + 1), members, k)


def for_members(ranked: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Hand a class's list of `k + 1` items to each member, without the member itself."""
    lists = ranked.select(F.col("query").alias("class"), F.col("item").alias("neighbour_id"), F.col("score").alias("similarity"))
    own = members.select(F.col("item").alias("query_id"), "class").join(lists, "class").drop("class")
    own = own.filter(F.col("query_id") != F.col("neighbour_id"))
    return top_n_per_key(own, ["query_id"], [F.desc("similarity"), F.asc("neighbour_id")], k)


def similar_by_words(docs: DataFrame, id_col: str, text_col: str, k: int = 10, hot_limit: int = HOT_LIMIT) -> DataFrame:
    """Best `k` other texts by Jaccard similarity of their word sets.

    Texts with equal word sets are compared once and then opened up again.
    """
    words = docs.select(F.col(id_col).alias("item"), F.array_distinct(tokens(F.coalesce(F.col(text_col), F.lit("")))).alias("w"))
    sets = materialise(words.select("item", F.size("w").alias("size"), F.explode("w").alias("dim")).withColumn("iw", F.lit(1.0)))
    members = materialise(copy_classes(sets.select("item", "dim", "iw")))
    heads = materialise(sets.join(members.filter(F.col("place") == 0), "item", "left_semi"))

    def order(a: str | None, v: dict):
        return [-fixed_of(v["common"] / (v["a_size"] + v["b_size"] - v["common"]))]

    best = top_partners(
        heads, k, entity="item", key="dim", value="iw", attrs=["size"], pattern_attrs=["size"], sums={"common": lambda a, b: 1},
        members=[F.asc("b_size")], order=order, lead=F.col("common") / (F.col("a_size") + F.col("b_size") - F.col("common")),
        bound=F.col("common") / F.col("size"), hot_limit=hot_limit,
    )
    score = fixed(F.col("common") / (F.col("a_size") + F.col("b_size") - F.col("common")))
    ranked = best.select(F.col("a_id").alias("query"), F.col("b_id").alias("class"), score.alias("score"))
    own = heads.select(F.col("item").alias("query"), F.col("item").alias("class"), F.lit(1.0).alias("score")).distinct()
    return for_members(expand_classes(ranked.unionByName(own), members, k + 1), members, k)


def with_product_details(similar: DataFrame, products: DataFrame, columns: tuple[str, ...] = ("title", "price", "main_category")) -> DataFrame:
    """Title, price and category of every neighbour."""
    info = products.select(F.col("item_id").alias("neighbour_id"), *columns)
    return similar.join(info, "neighbour_id", "left")


def with_user_details(similar: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review count and mean rating of every neighbour."""
    stats = reviews.groupBy(F.col("user_id").alias("neighbour_id")).agg(
        F.count("rating").alias("review_count"), F.avg("rating").alias("avg_rating")
    )
    return similar.join(stats, "neighbour_id", "left")


def hybrid_score(first: DataFrame, second: DataFrame, k: int = 5, weight: float = 0.6) -> DataFrame:
    """`weight * first + (1 - weight) * second` over both neighbour lists; a missing score is 0."""
    a = first.select("query_id", "neighbour_id", F.col("similarity").alias("a"))
    b = second.select("query_id", "neighbour_id", F.col("similarity").alias("b"))
    s = F.lit(weight) * F.coalesce("a", F.lit(0.0)) + F.lit(1 - weight) * F.coalesce("b", F.lit(0.0))
    both = a.join(b, ["query_id", "neighbour_id"], "full").select("query_id", "neighbour_id", fixed(s, 10).alias("similarity"))
    return top_n_per_key(both, ["query_id"], [F.desc("similarity"), F.asc("neighbour_id")], k)


def compare_methods(by_method: dict[str, DataFrame]) -> DataFrame:
    """Neighbour lists of several methods in one table with a `method` column."""
    out = None
    for method, df in by_method.items():
        part = df.select(F.lit(method).alias("method"), "query_id", "neighbour_id", "similarity", "rank")
        out = part if out is None else out.unionByName(part)
    return out


def comparison_table(compared: DataFrame, titles: DataFrame, methods: list[str], ranks: int = 5, width: int = 35) -> DataFrame:
    """Rank by method: one `title (score)` cell per method, an em dash where a list is short.

    titles: (id, title). Every query has all its ranks 1..`ranks`.
    """
    cells = compared.filter(F.col("rank") <= ranks).join(titles.select(F.col("id").alias("neighbour_id"), "title"), "neighbour_id", "left")
    cells = cells.withColumn("cell", score_cell("title", "similarity", width))
    every = compared.select("query_id").distinct().select("query_id", F.explode(F.sequence(F.lit(1), F.lit(ranks))).alias("rank"))
    wide = cells.groupBy("query_id", "rank").pivot("method", methods).agg(F.first("cell"))
    return every.join(wide, ["query_id", "rank"], "left").fillna("—", methods)


def top_score_per_method(compared: DataFrame) -> DataFrame:
    return compared.groupBy("query_id", "method").agg(F.max("similarity").alias("top_score"))


def short_titles(products: DataFrame, width: int = 60) -> DataFrame:
    return products.withColumn("title", ellipsis("title", width))
