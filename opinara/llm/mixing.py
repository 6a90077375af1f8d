"""Mixing sources to target weights with a low-discrepancy schedule.

A source's documents, in shuffled order, form a stream of words that repeats. The stream is
cut into blocks of equal words. Slots 0, 1, 2, ... of the mix are dealt to sources by golden
ratio points mapped through the cumulative weights, so that every stretch of the mix is close
to the targets; the j-th slot of a source takes its j-th block. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import materialise

GOLDEN = (math.sqrt(5) - 1) / 2
CHUNK = 1 << 16  # slots ranked by one task
BUCKET_ROWS = 100_000  # documents put in order by one task, about


def word_count(text: str = "text") -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cycle_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ..., `cycle`, repeating, by the source's code points, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))


def targets(sources: DataFrame, max_repeats: int = 3) -> DataFrame:
    """`sources` (source, source_size, weight) plus sid and target, the words the mix should take.

    The words of all sources are shared by weight; a source gets at most `max_repeats` times
    its size and what it leaves is shared among the rest. In ascending order of limit per
    weight, a source is at its limit if its share of what is left exceeds it. One row for each
    source passes through one task here.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    ranked = (
        sources.withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("all_words", F.sum("source_size").over(whole))
        .withColumn("sid", F.row_number().over(order).cast("long") - 1)
        .withColumn("left", F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(onward))
        .withColumn("full", F.col("cap") * F.col("weights") <= F.col("left") * F.col("weight"))
    )
    free = ~F.col("full")
    shared = ranked.withColumn("rest", F.max(F.when(free, F.col("left"))).over(whole)).withColumn("rest_weights", F.max(F.when(free, F.col("weights"))).over(whole))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise((F.col("rest") * F.col("weight")).cast("double") / F.col("rest_weights"))
    return shared.select("sid", "source", "source_size", "weight", target.alias("target"))


def golden_points(slot: Column) -> Column:
    """The fractional part of (slot + 1/2) times the golden ratio, exact enough for very large slots."""
    step = 1 << 20
    high, low = F.floor(slot / step), F.pmod(slot, F.lit(step))
    return F.pmod(high * F.lit((step * GOLDEN) % 1.0) + (low + 0.5) * F.lit(GOLDEN), F.lit(1.0))


def schedule(plan: DataFrame, block_words: int) -> DataFrame:
    """The slots of the mix: slot, sid, rank (of the slot in its source), words.

    `plan` has sid, goal (whole words) and blocks. A source with too many points loses its
    last; missing ranks follow at the end, so every source fills its goal exactly.
    """
    spark = plan.sparkSession
    ends = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    spans = materialise(plan.filter("blocks > 0").withColumn("end", F.sum("blocks").over(ends)).withColumn("begin", F.col("end") - F.col("blocks")))
    n, sources = spans.agg(F.coalesce(F.max("end"), F.lit(0)), F.count("*")).first()
    bins = max(1024, 4 * sources)
    points = spark.range(n).select(F.col("id").alias("slot"), golden_points(F.col("id")).alias("x")) if n else spark.range(0).select(F.col("id").alias("slot"), F.lit(0.0).alias("x"))
    at = F.col("x") * F.lit(n)
    ranges = spans.withColumn("bin", F.explode(F.sequence(F.floor(F.col("begin") * bins / F.lit(max(n, 1))), F.floor(F.col("end") * bins / F.lit(max(n, 1))))))
    dealt = points.withColumn("bin", F.floor(F.col("x") * bins)).join(ranges.select("sid", "begin", "end", "bin"), "bin") \
        .filter((F.floor(at) >= F.col("begin")) & (F.floor(at) < F.col("end"))).select("slot", "sid").withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    counts = dealt.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("sid", "chunk", "base")
    ranked = dealt.withColumn("place", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1) \
        .join(base, ["sid", "chunk"]).select("slot", "sid", (F.col("base") + F.col("place")).alias("rank"))
    kept = ranked.join(spans.select("sid", "blocks", "goal"), "sid").filter("rank < blocks").select("slot", "sid", "rank", "goal")
    had = counts.groupBy("sid").agg(F.sum("n").alias("had"))
    short = spans.join(had, "sid", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < blocks")
    missing = short.withColumn("rank", F.explode(F.sequence(F.col("had"), F.col("blocks") - 1)))
    tail = missing.select((F.lit(n) + F.col("begin") + F.col("rank")).alias("slot"), "sid", "rank", "goal")
    words = F.least(F.lit(block_words), F.col("goal") - F.col("rank") * block_words)
    return kept.union(tail).select("slot", "sid", "rank", words.cast("long").alias("words"))


def mix_sources(docs: DataFrame, weigh=cycle_weights, max_repeats: int = 3, block_words: int = 256) -> tuple[DataFrame, DataFrame]:
    """(per document, mix) for `docs` (doc_id, text, source); other columns are ignored.

    Per document: doc_id, source, size (words), source_size, target and taken (words the mix
    takes, repeats counted), one row for each input row. Mix: slot, sid, doc_id, start, words:
    which words of which document fill a slot. `weigh` adds weight (a positive long) to a table
    of source and source_size. A source's taken words are its target rounded to a whole number.

    Null source is a source of its own; null and empty texts have size 0 and take nothing; null
    doc_ids and repeated rows are rows like others; an empty table gives empty results. Documents are shuffled by md5 of
    the doc_id, so reruns agree.
    """
    slim = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("ticket")))
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    plan = materialise(targets(weigh(sizes.select("source", "source_size")), max_repeats)
                       .withColumn("goal", F.floor(F.col("target") + 0.5).cast("long"))
                       .withColumn("blocks", F.ceil(F.col("goal") / block_words).cast("long")))
    digits = max(1, math.ceil(math.log(max(1, slim.count() / BUCKET_ROWS), 16)))
    s, p = slim.alias("s"), plan.alias("p")
    rows = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "sid", "source_size", "target", "goal") \
        .withColumn("bucket", F.substring("ticket", 1, digits))
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("base", F.coalesce(F.sum("words").over(earlier), F.lit(0))).select("sid", "bucket", "base")
    inside = Window.partitionBy("sid", "bucket").orderBy("ticket", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(base, ["sid", "bucket"]) \
        .withColumn("start", F.col("base") + F.col("before"))
    columns = ["doc_id", "source", "size", "source_size", "target"]
    full = placed.filter("size > 0").select(*columns, "sid", "goal", "start")
    # one piece for each repeat of the stream and each block the document touches
    turns = F.when(F.col("goal") > F.col("start"), F.sequence(F.lit(0).cast("long"), F.floor((F.col("goal") - F.col("start") - 1) / F.col("source_size"))))
    repeats = full.withColumn("turn", F.explode_outer(turns)).withColumn("a", F.col("start") + F.col("turn") * F.col("source_size"))
    end = F.least(F.col("a") + F.col("size"), F.col("goal"))
    touched = F.when(F.col("a").isNotNull(), F.sequence(F.floor(F.col("a") / block_words), F.floor((end - 1) / block_words)))
    pieces = repeats.withColumn("rank", F.explode_outer(touched))
    slots = schedule(plan.select("sid", "goal", "blocks"), block_words)
    first = F.greatest(F.col("a"), F.col("rank") * block_words)
    last = F.least(F.col("a") + F.col("size"), F.col("rank") * block_words + F.col("words"))
    joined = pieces.join(slots, ["sid", "rank"], "left").withColumn("from_word", first - F.col("a")).withColumn("n", F.coalesce(F.greatest(last - first, F.lit(0)), F.lit(0)))
    mix = joined.filter("n > 0").select("slot", "sid", "doc_id", F.col("from_word").alias("start"), F.col("n").alias("words"))
    taken = joined.groupBy(*columns, "sid", "start").agg(F.sum("n").alias("taken")).select(*columns, "taken")
    none = placed.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))
    return taken.union(none), mix
