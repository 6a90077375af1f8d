"""Recommenders: user- and item-based, content-based, hybrid, popularity, cold start."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.scalars import fixed
from opinara.operators.partners import HOT_LIMIT
from opinara.operators.scores import copy_classes, expand_classes, top_scores
from opinara.operators.toprows import hot_keys, top_n_per_key
from opinara.session import materialise

LIKED = 3  # item-based: rated above this
LIKED_CONTENT = 4  # content-based: rated at least this


def rating_matrix(reviews: DataFrame) -> DataFrame:
    """Mean rating per (user, item), kept long."""
    return reviews.groupBy("user_id", "item_id").agg(
        (F.sum("rating").cast("double") / F.count("rating")).alias("rating")
    )


def matrix_sparsity(ratings: DataFrame) -> DataFrame:
    """One row: users, items, filled cells and the empty share of the matrix."""
    return ratings.agg(
        F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"),
        F.count_if(F.col("rating") != 0).alias("n_filled"),
    ).withColumn("sparsity", 1 - F.col("n_filled") / (F.col("n_users") * F.col("n_items")))


def with_norm(ratings: DataFrame, entity: str) -> DataFrame:
    norms = ratings.groupBy(entity).agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"))
    return ratings.join(norms, entity)


def cosine_neighbours(ratings: DataFrame, k: int, entity: str = "user_id", key: str = "item_id", hot_limit: int = HOT_LIMIT) -> DataFrame:
    """The `k` most similar entities of each, by cosine of their rating vectors, those with a positive one.

    The query's own norm scales all of its scores alike, so it takes no part in the order. Sums and norms are rounded, their
    quotient is not: partners with equal sums tie exactly if their rounded norms are equal. The rows of a hot key are
    visited from the largest weight down until no other can enter the list (see `scores.top_scores`).
    """
    edges = materialise(with_norm(ratings, entity).select(F.col(entity).alias("item"), F.col(key).alias("dim"), F.col("rating").alias("iw"), "norm"))
    queries = edges.select(F.col("item").alias("query"), "dim", F.col("iw").alias("qw"))
    norms = edges.groupBy(F.col("item").alias("query")).agg(F.first("norm").alias("own"))
    best = top_scores(queries, edges, k, norms.select("query", F.col("query").alias("item")), hot_limit, None)
    sim = fixed(F.col("score") / (F.col("norm") * F.col("own")))
    return best.join(norms, "query").select(F.col("query").alias(entity), F.col("item").alias("neighbour"), sim.alias("similarity"), "rank")


def _rated(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.col("user_id").alias("query"), F.col("item_id").alias("item"))


def _as_recs(scored: DataFrame) -> DataFrame:
    return scored.select(F.col("query").alias("user_id"), F.col("item").alias("item_id"), "score", "rank")


def recommend_user_based(ratings: DataFrame, n: int = 10, n_neighbours: int = 50, neighbours: DataFrame | None = None,
                         hot_limit: int = HOT_LIMIT) -> DataFrame:
    """Similarity-weighted mean rating over each user's neighbours, rated items left out.

    An item a neighbour has not rated counts as 0, so the divisor is the sum
    over all neighbours kept.
    """
    if neighbours is None:
        neighbours = cosine_neighbours(ratings, n_neighbours, hot_limit=hot_limit)
    return _as_recs(top_scores(*_neighbour_votes(ratings, neighbours), n, _rated(ratings)))


def _neighbour_votes(ratings: DataFrame, neighbours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User-based scores as sums over neighbours: the users' weights (query, dim, qw) and the items' ratings (item, dim, iw)."""
    near = neighbours.filter(F.col("similarity") > 0)
    total = F.sum("similarity").over(Window.partitionBy("user_id"))  # at most n_neighbours rows per user
    queries = near.select(
        F.col("user_id").alias("query"), F.col("neighbour").alias("dim"), (F.col("similarity") / total).alias("qw")
    )
    return queries, ratings.select(F.col("item_id").alias("item"), F.col("user_id").alias("dim"), F.col("rating").alias("iw"))


def recommend_item_based(ratings: DataFrame, n: int = 10, hot_limit: int = HOT_LIMIT) -> DataFrame:
    """Rating-weighted similarity to the items a user rated above 3, divided by their number.

    A similarity of two items is a sum over the users who rated both, so the score is gathered in two hops
    and no item-item matrix is built: first a user's pull on every other user through the liked items, then that pull times the other
    user's weights. Items with more than `hot_limit` raters pair no users: each is a dimension of its own, whose
    list is its similarity to all items.
    """
    edges = materialise(
        with_norm(ratings, "item_id").select("user_id", "item_id", "rating", (F.col("rating") / F.col("norm")).alias("w"))
    )
    liked = edges.filter(F.col("rating") > LIKED)
    counts = liked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_liked"))
    liked = liked.join(counts, "user_id").select(
        F.col("user_id").alias("query"), "item_id", (F.col("rating") / F.col("n_liked")).alias("q")
    )
    hot = hot_keys(edges, ["item_id"], hot_limit)
    cold = edges if hot is None else edges.join(hot, "item_id", "left_anti")
    pull = (
        liked.join(cold.select("item_id", F.col("user_id").alias("dim"), "w"), "item_id").filter(F.col("query") != F.col("dim"))
        .groupBy("query", "dim").agg(F.sum(F.col("q") * F.col("w")).alias("qw"))
    )
    lists = edges.select(F.col("item_id").alias("item"), F.col("user_id").alias("dim"), F.col("w").alias("iw"))
    if hot is not None:
        named = lambda kind, c: F.concat_ws(":", F.lit(kind), F.col(c).cast("string"))
        raters = edges.join(hot, "item_id", "left_semi").select(F.col("item_id").alias("of"), "user_id", F.col("w").alias("x"))
        similar = raters.join(edges.select("user_id", F.col("item_id").alias("item"), "w"), "user_id").groupBy("item", "of").agg(F.sum(F.col("x") * F.col("w")).alias("iw"))
        pull = pull.withColumn("dim", named("u", "dim")).unionByName(
            liked.join(hot, "item_id", "left_semi").select("query", named("i", "item_id").alias("dim"), F.col("q").alias("qw"))
        )
        lists = lists.withColumn("dim", named("u", "dim")).unionByName(similar.select("item", named("i", "of").alias("dim"), "iw"))
    return _as_recs(top_scores(pull, lists, n, _rated(ratings), hot_limit))


def liked_items(reviews: DataFrame, model_items: DataFrame, fallback: int = 3) -> DataFrame:
    """Reviews that shape a user's profile, one row per review.

    Rated 4 or more; a user without any such review in the model gives the best
    three reviews instead (the item id settles ties). Only items of the model stay.
    """
    known = reviews.join(model_items.select("item_id").distinct(), "item_id", "left_semi").select("user_id", "item_id", "rating")
    good = known.filter(F.col("rating") >= LIKED_CONTENT).select("user_id", "item_id")
    # The best three are picked over all items, as the model filter comes after.
    best = top_n_per_key(
        reviews.select("user_id", "item_id", "rating").join(good.select("user_id").distinct(), "user_id", "left_anti"),
        ["user_id"], [F.desc("rating"), F.asc("item_id")], fallback,
    ).select("user_id", "item_id")
    return good.unionByName(best.join(model_items.select("item_id").distinct(), "item_id", "left_semi"))


def content_scores(reviews: DataFrame, features: DataFrame, n: int = 10, hot_limit: int = 10_000) -> DataFrame:
    """Mean cosine to the liked items, rated items left out.

    features: (item_id, term, weight), unit length per item. The mean of cosines
    is the dot product with the mean liked vector, so one profile per user
    replaces one comparison per liked item. Items with equal vectors are scored once.
    """
    features = materialise(features.select("item_id", "term", "weight"))
    profile = materialise(_profiles(reviews, features))
    vectors = features.select(F.col("item_id").alias("item"), F.col("term").alias("dim"), F.col("weight").alias("iw"))
    members = materialise(copy_classes(vectors))
    heads = vectors.join(members.filter(F.col("place") == 0), "item", "left_semi")
    rated = materialise(reviews.select(F.col("user_id").alias("query"), F.col("item_id").alias("item")).distinct())
    rated = rated.join(members.select("item"), "item", "left_semi")
    ranked = _class_scores(profile, heads, rated, members, n, hot_limit)
    return _as_recs(expand_classes(ranked, members, n, rated))


def _profiles(reviews: DataFrame, features: DataFrame) -> DataFrame:
    """(query, dim, qw): the mean vector of what each user likes."""
    liked = liked_items(reviews, features)
    per_user = liked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_liked"))
    return (
        liked.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("times"))
        .join(per_user, "user_id").join(features, "item_id")
        .groupBy("user_id", "term").agg(F.sum(F.col("times") / F.col("n_liked") * F.col("weight")).alias("qw"))
        .select(F.col("user_id").alias("query"), F.col("term").alias("dim"), "qw")
    )


def _class_scores(profile: DataFrame, heads: DataFrame, rated: DataFrame, members: DataFrame, n: int, hot_limit: int) -> DataFrame:
    """Best classes per user, enough for `n` unrated items.

    A class whose lowest member is unrated ranks by that member. The others hold
    a rated item each, so they are few: they are all scored and added.
    """
    top = top_scores(profile, heads, n, rated, hot_limit).select("query", F.col("item").alias("class"), "score")
    seen = rated.join(members.filter(F.col("place") == 0), "item").select("query", F.col("class").alias("item"))
    also = (
        seen.join(profile, "query").join(heads, ["item", "dim"]).groupBy("query", "item")
        .agg(fixed(F.sum(F.col("qw") * F.col("iw"))).alias("score")).filter(F.col("score") > 0)
    )
    return top.unionByName(also.select("query", F.col("item").alias("class"), "score"))


def recommend_content_based(reviews: DataFrame, features: DataFrame, n: int = 10) -> DataFrame:
    return content_scores(reviews, features, n)


def recommend_hybrid(user_based: DataFrame, content: DataFrame, alpha: float = 0.5, n: int = 10, scale: bool = False) -> DataFrame:
    """`alpha * user score + (1 - alpha) * content score` over both lists; a missing score is 0.

    The lists are the two methods' top 50. `scale` brings each list to 0..1 per user first.
    """
    if scale:
        user_based, content = _min_max_per_user(user_based), _min_max_per_user(content)
    u = user_based.select("user_id", "item_id", F.col("score").alias("u"))
    c = content.select("user_id", "item_id", F.col("score").alias("c"))
    score = F.lit(alpha) * F.coalesce("u", F.lit(0.0)) + F.lit(1 - alpha) * F.coalesce("c", F.lit(0.0))
    both = u.join(c, ["user_id", "item_id"], "full").select("user_id", "item_id", fixed(score, 10).alias("score"))
    return top_n_per_key(both, ["user_id"], [F.desc("score"), F.asc("item_id")], n)


def recommend_hybrid_complete(reviews: DataFrame, features: DataFrame, alpha: float = 0.5, n: int = 10, n_neighbours: int = 50,
                              hot_limit: int = HOT_LIMIT) -> DataFrame:
    """`alpha * user-based score + (1 - alpha) * content score` of every item a user has not rated, without pools.

    Both scores are sums of products, over neighbours and over terms, so their mix is one sum over both kinds of dimensions and no item
    loses the part in which it ranks low. Users with neighbours only or with a profile only have that part.
    """
    ratings, features = materialise(rating_matrix(reviews)), materialise(features.select("item_id", "term", "weight"))
    votes, rated = _neighbour_votes(ratings, cosine_neighbours(ratings, n_neighbours, hot_limit=hot_limit))
    named = lambda kind: F.concat_ws(":", F.lit(kind), F.col("dim").cast("string"))
    queries = votes.withColumns({"dim": named("user"), "qw": F.col("qw") * alpha}).unionByName(
        _profiles(reviews, features).withColumns({"dim": named("term"), "qw": F.col("qw") * (1 - alpha)}))
    terms = features.select(F.col("item_id").alias("item"), F.col("term").alias("dim"), F.col("weight").alias("iw"))
    items = rated.withColumn("dim", named("user")).unionByName(terms.withColumn("dim", named("term")))
    gone = reviews.select(F.col("user_id").alias("query"), F.col("item_id").alias("item")).distinct()
    return _as_recs(top_scores(queries, items, n, gone))


def _min_max_per_user(recs: DataFrame) -> DataFrame:
    w = Window.partitionBy("user_id")
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    return recs.withColumn("score", F.when(hi > lo, (F.col("score") - lo) / (hi - lo)).otherwise(1.0))


def popularity(reviews: DataFrame) -> DataFrame:
    """Review count times mean rating per item."""
    return reviews.groupBy("item_id").agg(
        F.count("rating").alias("rating_count"), F.avg("rating").alias("avg_rating"),
        (F.count("rating") * F.avg("rating")).alias("popularity"),
    )


def recommend_popular(reviews: DataFrame, n: int = 10) -> DataFrame:
    return popularity(reviews).orderBy(F.desc(F.round("popularity", 6)), F.asc("item_id")).limit(n)


def popular_for(users: DataFrame, reviews: DataFrame, n: int = 10) -> DataFrame:
    """The popular list for every given user; the list (n rows) rides along as one array value."""
    entry = F.struct((-F.round("popularity", 6)).alias("_order"), "item_id", F.round("popularity", 6).alias("score"))
    popular = recommend_popular(reviews, n).agg(F.array_sort(F.collect_list(entry)).alias("l")).scalar()
    return users.select("user_id").distinct().select("user_id", F.posexplode(popular)).select(
        "user_id", "col.item_id", "col.score", (F.col("pos") + 1).alias("rank"), F.lit("popularity").alias("source")
    )


def recommend_for_new_users(users: DataFrame, reviews: DataFrame, recs: DataFrame | None = None, n: int = 10) -> DataFrame:
    """Popular items for users without a review, and `recs` for the others."""
    cold = popular_for(users.join(reviews.select("user_id"), "user_id", "left_anti"), reviews, n)
    if recs is None:
        return cold
    warm = recs.join(users.select("user_id"), "user_id", "left_semi")
    return cold.unionByName(warm.select("user_id", "item_id", "score", "rank", F.lit("history").alias("source")))


def content_model_items(ratings: DataFrame, products: DataFrame, max_products: int | None = None, seed: int = 42) -> DataFrame:
    """Products of the content model: the rated ones, then a seeded sample of the rest up to a cap.

    Without a cap the whole catalogue is used.
    """
    if max_products is None:
        return products
    rated = products.join(ratings.select("item_id"), "item_id", "left_semi").withColumn("_late", F.lit(0))
    rest = products.join(ratings.select("item_id"), "item_id", "left_anti").withColumn("_late", F.lit(1))
    ticket = F.md5(F.concat(F.lit(f"{seed}:"), F.col("item_id").cast("string")))
    return rated.unionByName(rest).orderBy("_late", ticket, "item_id").limit(max_products).drop("_late")


def recommendation_report(recs: dict[str, DataFrame], products: DataFrame, users: DataFrame, per_method: int = 5) -> DataFrame:
    """Per user and method the best items with title and score rounded to 3."""
    rows = None
    for method, df in recs.items():
        part = df.filter(F.col("rank") <= per_method).join(users.select("user_id"), "user_id", "left_semi")
        part = part.withColumn("method", F.lit(method)).select("method", "user_id", "item_id", "score", "rank")
        rows = part if rows is None else rows.unionByName(part)
    titled = rows.join(products.select("item_id", "title"), "item_id", "left").withColumn("title", F.coalesce("title", F.lit("Unknown")))
    entry = F.struct("rank", "item_id", "title", F.round("score", 3).alias("score"))
    return titled.groupBy("user_id", "method").agg(F.array_sort(F.collect_list(entry)).alias("recommendations"))
