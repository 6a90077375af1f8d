"""Text quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed byte trigrams (case and symbols included) and of words that
repeat the word before; square roots of the shares, weighted by rarity, are reduced to `rank`
dimensions by a singular value decomposition of a bounded sample of labelled texts. The
sample's vectors are broadcast: at most `max_labelled` rows of `rank` numbers, whatever the
corpus. Every document's cosines with all of them are computed in blocks, and the labels of
the `k` nearest vote with their similarity as weight.

A text never meets its own label: labelled texts equal to it do not vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import share, shared_value
from opinara.llm.tokens import Tokenizer, space_table

BUCKETS, MAX_LABELLED, RANK, NEIGHBOURS = 2048, 4096, 64, 25
BLOCK = 256  # documents in one product with the labelled vectors


class Model(NamedTuple):
    """What scoring needs; `vectors` are unit length, `keys` name their texts."""

    buckets: int
    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    weights: np.ndarray
    keys: np.ndarray
    prior: float


def features(column, buckets: int) -> Iterator[np.ndarray]:
    """Blocks of rows: square roots of the shares of each trigram bucket, and of repeated words in the last column."""
    tokens = Tokenizer(space_table(), 512 << 10)
    for w in tokens.slices(column):
        data = w.data.astype(np.uint32)
        out = np.zeros((w.rows, buckets + 1), np.float32)
        row_of_word = np.repeat(np.arange(w.rows), np.diff(w.offsets))
        if len(w.starts):
            # trigrams start inside words and may end in the space after
            position = np.zeros(len(data) + 1, np.int64)
            np.add.at(position, w.starts, 1)
            np.add.at(position, w.ends, -1)
            at = np.flatnonzero(np.cumsum(position)[:len(data)] > 0)
            row = row_of_word[np.searchsorted(w.starts, at, "right") - 1]
            padded = np.concatenate([data, np.full(2, 32, np.uint32)])
            code = padded[at] * np.uint32(0x9E3779B1) + padded[at + 1] * np.uint32(0x85EBCA77) + padded[at + 2] * np.uint32(0xC2B2AE3D)
            code ^= code >> np.uint32(15)
            code *= np.uint32(0x2C1B3C6D)
            bucket = (code >> np.uint32(12)) % np.uint32(buckets)
            counts = np.bincount(row * buckets + bucket, minlength=w.rows * buckets).reshape(w.rows, buckets)
            lengths = counts.sum(axis=1)
            out[:, :buckets] = np.sqrt(counts / np.maximum(lengths, 1)[:, None])
            again = np.flatnonzero((w.hashes[1:] == w.hashes[:-1]) & (row_of_word[1:] == row_of_word[:-1])) + 1
            out[:, buckets] = np.sqrt(np.bincount(row_of_word[again], minlength=w.rows) / np.maximum(np.diff(w.offsets), 1))
        yield out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _sample_rows(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for block in features(batch.column(0), buckets):
                part = batch.slice(start, len(block))
                start += len(block)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([x.astype(np.float16).tobytes() for x in block], pa.binary())], names=["key", "vote", "x"])

    return rows


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", max_labelled: int = MAX_LABELLED, rank: int = RANK, buckets: int = BUCKETS) -> Model:
    """Learn from the rows of `labels` (doc_id, `label` 0 or 1) for which `learn` holds.

    The sample is `max_labelled` documents at most, half of each label where there are enough,
    picked by a hash of the doc_id; votes are weighted so that each label counts by its share of all
    labels. Null doc_ids and labels other than 0 and 1 are left out; a doc_id labelled twice
    has its mean label, as have equal texts of the sample.
    """
    known = labels.filter(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.avg(label).alias("vote"))
    high = F.col("vote") >= 0.5
    shares = {r[0]: r[1] for r in known.groupBy(high.alias("high")).count().collect()}
    pick = lambda side: known.filter(side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled // 2)
    picked = pick(high).union(pick(~high))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    rows = texts.select("text", F.xxhash64("text").alias("key"), "vote").mapInArrow(_sample_rows(buckets), "key bigint, vote double, x binary")
    found: dict[int, list] = {}
    for key, vote, x in rows.orderBy("key").limit(max_labelled).collect():
        found.setdefault(key, [x]).append(vote)
    sample = {key: (sum(votes) / len(votes), x) for key, (x, *votes) in found.items()}
    prior = shares.get(True, 0) / max(sum(shares.values()), 1)
    if not sample:
        return Model(buckets, np.ones(buckets + 1, np.float32), np.zeros((buckets + 1, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), np.zeros(0), np.zeros(0, np.int64), 0.5)
    x = np.stack([np.frombuffer(v[1], np.float16) for v in sample.values()]).astype(np.float32)
    votes = np.array([v[0] for v in sample.values()])
    rarity = np.log1p(len(x) / (1 + (x > 0).sum(axis=0))).astype(np.float32)
    x = _unit(x * rarity)
    values, axes = np.linalg.eigh(x.T.astype(np.float64) @ x)
    axes = axes[:, ::-1][:, :rank].astype(np.float32)
    ups = votes >= 0.5
    weights = np.where(ups, prior / max(ups.sum(), 1), (1 - prior) / max((~ups).sum(), 1))
    return Model(buckets, rarity, axes, _unit(x @ axes), votes, weights / weights.mean(), np.array(list(sample), np.int64), prior)


def _scores(model: Model, k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared_value(model)
        for batch in batches:
            keys, out = np.asarray(batch.column(1)), []
            start = 0
            for block in features(batch.column(0), m.buckets):
                for i in range(0, len(block), BLOCK):
                    x = block[i:i + BLOCK]
                    own = keys[start + i:start + i + len(x)]
                    blank = ~x.any(axis=1)
                    near = np.maximum(_unit(_unit(x * m.rarity) @ m.axes) @ m.vectors.T, 0)
                    near[own[:, None] == m.keys[None, :]] = 0
                    if near.shape[1] > k:
                        top = np.argpartition(near, -k, axis=1)[:, -k:]
                        near = np.take_along_axis(near, top, axis=1)
                        votes, weights = m.votes[top], m.weights[top]
                    else:
                        votes, weights = m.votes[None, :], m.weights[None, :]
                    weights = near.astype(np.float64) ** 4 * weights
                    total = weights.sum(axis=1)
                    found = np.where(total > 0, (weights * votes).sum(axis=1) / np.where(total > 0, total, 1), m.prior)
                    out.append(np.where(blank, m.prior, found))
                start += len(block)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(np.clip(np.concatenate(out), 0, 1) if out else np.empty(0))], names=["doc_id", "score"])

    return score


def score_quality(docs: DataFrame, model: Model, k: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, score, predicted) for every row of `docs` (doc_id, text); other columns are ignored.

    `score` is between 0 and 1, higher for label 1; null, empty and blank texts get the share of label 1 among
    all learned labels, as does a text near no labelled one. Repeated rows score alike; an empty table gives an empty result.
    """
    shared = share(docs.sparkSession, model)
    docs = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64(F.col("text").cast("string")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"))
    scored = docs.mapInArrow(_scores(shared, k), "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
