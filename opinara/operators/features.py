"""Feature vectors of products and users."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions import scalars as S
from opinara.functions.vectors import as_doubles, l2_normalise, padded, scaled

METADATA = ("price", "category", "avg_rating", "rating_count", "has_description", "has_features")
PATTERN = ("avg_rating", "rating_std", "review_count", "min_rating", "max_rating", "total_helpful", "verified_ratio", "avg_text_length")


def rating_patterns(reviews: DataFrame) -> DataFrame:
    """Per user: rating mean, deviation, count, range, helpful votes, verified share, text length."""
    return reviews.groupBy("user_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("rating_std"),
        F.count("rating").alias("review_count"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.sum("helpful_vote").alias("total_helpful"),
        F.avg(F.col("verified_purchase").cast("double")).alias("verified_ratio"),
        F.coalesce(F.avg(F.length("text")), F.lit(0.0)).alias("avg_text_length"),
    )


def category_affinity(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """(`user_id`, `main_category`, `n`, `share`); reviews of unknown products count for no category.

    Counts combine per (user, category) first, so the share is taken over a few
    rows per user.
    """
    joined = reviews.select("user_id", "item_id").join(products.select("item_id", "main_category"), "item_id", "left")
    counts = joined.filter(F.col("main_category").isNotNull()).groupBy("user_id", "main_category").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("user_id")))


def category_affinity_wide(reviews: DataFrame, products: DataFrame, categories: list[str]) -> DataFrame:
    """One column per category, 0 where a user has none. Naming the categories saves a pass."""
    long = category_affinity(reviews, products)
    return long.groupBy("user_id").pivot("main_category", categories).agg(F.sum("share")).fillna(0.0, categories)


def min_max_scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column to 0..1; a constant column keeps its values."""
    span = df.agg(F.struct(*[x for c in columns for x in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]).alias("s")).scalar()
    scale = lambda c: F.when(span[f"{c}_hi"] > span[f"{c}_lo"], (F.col(c) - span[f"{c}_lo"]) / (span[f"{c}_hi"] - span[f"{c}_lo"])).otherwise(F.col(c))
    return df.withColumns({c: scale(c) for c in columns})


def z_scored(df: DataFrame, columns: list[str], sample: bool = True) -> DataFrame:
    """(x - mean) / deviation with the sample or population deviation; a constant column becomes 0."""
    dev = F.stddev_samp if sample else F.stddev_pop
    stats = df.agg(F.struct(*[x for c in columns for x in (F.avg(c).alias(f"{c}_m"), dev(c).alias(f"{c}_s"))]).alias("s")).scalar()
    z = lambda c: (F.col(c) - stats[f"{c}_m"]) / F.when(F.coalesce(stats[f"{c}_s"], F.lit(0.0)) > 0, stats[f"{c}_s"]).otherwise(1.0)
    return df.withColumns({c: z(c) for c in columns})


def metadata_features(products: DataFrame, bucket: Callable[[str], Column] = S.hash_bucket) -> DataFrame:
    """(`item_id`, six columns scaled to 0..1): price, category code, rating, capped count, two flags."""
    have = set(products.columns)
    positive = lambda c: F.when(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) > 0, F.col(c).cast("double")).otherwise(0.0)
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("double")
    described = flag(F.length("description") > 10) if "description" in have else F.lit(0.0)
    featured = S.has_real_item("features").cast("double") if "features" in have else F.lit(0.0)
    base = products.select(
        "item_id",
        positive("price").alias("price"),
        bucket(F.coalesce(F.col("main_category"), F.lit("Unknown"))).alias("category"),
        F.coalesce(F.col("average_rating").cast("double"), F.lit(0.0)).alias("avg_rating"),
        S.capped_ratio("rating_number").alias("rating_count"),
        described.alias("has_description"),
        featured.alias("has_features"),
    )
    return min_max_scaled(base, list(METADATA))


def as_vector(df: DataFrame, id_col: str, columns: list[str], normalise: bool = False) -> DataFrame:
    """(`id`, `vector`) from numeric columns."""
    v = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return df.select(F.col(id_col).alias("id"), (l2_normalise(v) if normalise else v).alias("vector"))


def hybrid_weighted(terms: Column | str, text: Column | str, metadata: Column | str, width: int,
                    weights: tuple[float, float, float] = (0.5, 0.4, 0.1)) -> Column:
    """Weighted blocks cut to `width` entries each (metadata zero-padded), joined, unit length."""
    parts = [padded(scaled(v, w), width) for v, w in zip((terms, text, metadata), weights)]
    return l2_normalise(F.concat(*parts))


def hybrid_truncated(terms: Column | str, text: Column | str, metadata: Column | str, width: int = 128) -> Column:
    """The first `width` entries of both text blocks and all metadata, joined, unit length."""
    return l2_normalise(F.concat(F.slice(as_doubles(terms), 1, width), F.slice(as_doubles(text), 1, width), as_doubles(metadata)))


def user_texts(reviews: DataFrame, order: list[str], user: str = "user_id", max_chars: int | None = None) -> DataFrame:
    """Each user's titles and texts joined in order; `max_chars` shortens the result where a caller wants an excerpt.

    The text is one value, so a user's history has to fit in one row. For text
    features sum counts of words per user instead.
    """
    piece = F.concat(F.coalesce("title", F.lit("")), F.lit(". "), F.coalesce("text", F.lit("")))
    rows = reviews.select(user, F.struct(*order, piece.alias("_piece")).alias("_r"))
    joined = rows.groupBy(user).agg(F.array_sort(F.collect_list("_r")).alias("_p"))
    text = F.array_join(F.transform("_p", lambda p: p["_piece"]), " ")
    return joined.select(user, (text if max_chars is None else F.substring(text, 1, max_chars)).alias("combined_text"))


def hashed_vectors(weights: DataFrame, id_col: str, term_col: str, weight: Column | None = None, dim: int = 256) -> DataFrame:
    """(`id`, `vector`): the weights of each id's terms (default: 1 a row) summed into `dim` md5 buckets, unit length.

    Sums combine in the map tasks and at most `dim` numbers of an id meet, so a user with a third of
    all rows costs no more than others. Ids without terms are left out.
    """
    bucket = F.pmod(F.conv(F.substring(F.md5(term_col), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")
    sums = weights.groupBy(F.col(id_col).alias("id"), bucket.alias("b")).agg(F.sum(F.lit(1.0) if weight is None else weight).alias("s"))
    cells = sums.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("b", "s"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    return cells.select("id", l2_normalise(dense).alias("vector"))


def user_text_vectors(reviews: DataFrame, user: str = "user_id", columns: tuple[str, ...] = ("title", "text"), dim: int = 256) -> DataFrame:
    """(`id`, `vector`) of all words that a user wrote, however long the history; no text is joined up."""
    from opinara.functions.text import tokens

    words = reviews.select(user, F.explode(tokens(F.concat_ws(" ", *columns))).alias("_w"))
    return hashed_vectors(words, user, "_w", dim=dim)


def text_embeddings(df: DataFrame, id_col: str, text_col: str, encoder: Callable[[list[str]], list[list[float]]] | None = None,
                    batch: int = 64, dim: int = 256) -> DataFrame:
    """(`id`, `vector`) unit-length text vectors.

    `encoder` maps a batch of texts to vectors and runs inside the tasks. Without
    one, words are hashed into `dim` counts on the JVM side.
    """
    if encoder is None:
        from pyspark.ml.feature import HashingTF
        from pyspark.ml.functions import vector_to_array

        from opinara.functions.text import tokens

        words = df.select(F.col(id_col).alias("id"), tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("_w"))
        counted = HashingTF(numFeatures=dim, inputCol="_w", outputCol="_v").transform(words)
        return counted.select("id", l2_normalise(vector_to_array("_v")).alias("vector"))

    def encode(batches: Iterator):
        import pandas as pd

        for pdf in batches:
            texts = pdf["text"].tolist()
            vectors = [v for i in range(0, len(texts), batch) for v in encoder(texts[i:i + batch])]
            yield pd.DataFrame({"id": pdf["id"], "vector": [[float(x) for x in v] for v in vectors]})

    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.mapInPandas(encode, f"id {dict(src.dtypes)['id']}, vector array<double>").select("id", l2_normalise("vector").alias("vector"))


def word_vectors(df: DataFrame, id_col: str, text_col: str, dim: int = 64, min_count: int = 2, seed: int = 42, part_rows: int = 250_000) -> DataFrame:
    """(`id`, `vector`) mean of word vectors trained on the texts, unit length.

    Every task trains on about `part_rows` texts, which it holds, and the words' vectors are averaged over the tasks.
    """
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    from opinara.functions.text import tokens

    words = df.select(F.col(id_col).alias("id"), tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("_w"))
    parts = max(1, -(-words.count() // part_rows))  # one would gather all texts in one task
    model = Word2Vec(vectorSize=dim, minCount=min_count, seed=seed, numPartitions=parts, inputCol="_w", outputCol="_v").fit(words)
    return model.transform(words).select("id", l2_normalise(vector_to_array("_v")).alias("vector"))
