"""Masked pseudo-likelihood of documents under a small bidirectional window network.

All documents' words are counted in Spark by their 64-bit hashes, each word by itself. Frequent words
are classes of their own, the others are grouped into classes of equal weight. The table of distinct
words (15 bytes each, and an index of 4 to 8) is broadcast, so it grows with the vocabulary. The network reads
`reach` words on either side of a hidden one and gives the class probabilities; within a class the
corpus counts decide. A document's score is the sum of log P(word | both sides) over its words.

Training covers all documents: in a round every task hides one word in `mask_every` of its documents
(other ones in each round, from a place that the document's first word decides, so that no place is left out), does stochastic gradient steps in numpy from the shared parameters, and
the parameters are averaged over tasks, weighted by hidden words, in a tree of grouped sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.tokens import Tokenizer, space_table

BUCKET_BITS = 16  # least bits of the index of the words
HELD_WORDS = 2_000_000  # hashes that a task holds before it adds them up
CLASSES, INPUTS, WIDTH, HIDDEN, REACH = 256, 4096, 16, 32, 2
ROUNDS, MASK_EVERY, BATCH, RATE = 2, 8, 512, 0.08
PIECE, FAN_IN, LEVELS = 2048, 256, 3
SLICE_BYTES = 1 << 18  # text that is spread out into arrays at once
SCORE_ROWS = 1024  # their logits stay in the cache
SAFE = 80.0  # exp of at most this stays finite in single precision


class Vocabulary(NamedTuple):
    classes: np.ndarray  # class of each word; the last word stands for all unseen ones
    inputs: np.ndarray  # input id of each word; the last id pads
    within: np.ndarray  # log P(word | class)
    prior: np.ndarray  # log P(class)
    words: np.ndarray  # the sorted hashes, and the largest number behind them
    first: np.ndarray  # where the hashes with the same first bits begin


class Network(NamedTuple):
    inputs: np.ndarray
    mixing: np.ndarray  # (2 * reach * width) x hidden
    shift: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray


def share(docs: DataFrame, vocabulary: Vocabulary, net: Network) -> Broadcast:
    """The plain arrays, of which a worker holds one copy."""
    return docs.sparkSession.sparkContext.broadcast((tuple(vocabulary), tuple(net)))


def shared_model(shared: Broadcast) -> tuple[Vocabulary, Network]:
    vocabulary, net = shared.value
    return Vocabulary(*vocabulary), Network(*net)


def numbers_of(vocabulary: Vocabulary, hashes: np.ndarray) -> np.ndarray:
    """The number of each word; unseen words have the last one."""
    bits = len(vocabulary.first).bit_length() - 1
    at = vocabulary.first[hashes >> np.uint64(64 - bits)].astype(np.int64)
    left = np.arange(len(hashes))
    while len(left):
        left = left[vocabulary.words[at[left]] < hashes[left]]
        at[left] += 1
    at[vocabulary.words[at] != hashes] = len(vocabulary.words) - 1
    return at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, held, n = Tokenizer(space_table(), SLICE_BYTES), [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        words, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, place, np.concatenate([h[1] for h in held]))
        return words, total

    def rows(words: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(total)], names=["word", "n"])

    for batch in batches:
        for w in tokens.slices(batch.column(0)):
            held.append(np.unique(w.hashes, return_counts=True))
            n += len(held[-1][0])
            if n > HELD_WORDS:
                held = [added()]
                n = len(held[0][0])
                if 2 * n > HELD_WORDS:
                    yield rows(*held[0])
                    held, n = [], 0
    if held:
        yield rows(*added())


def count_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, occurrences) of each distinct word of all documents, by hash."""
    table = docs.select("text").mapInArrow(_count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    words, n = table["word"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(words)
    return words[order], n[order]


def build_vocabulary(counts: np.ndarray, words: np.ndarray | None = None) -> Vocabulary:
    """From the occurrences of the sorted hashes `words` and, as the last entry, of unseen words; without `words` numbers cannot be looked up."""
    words = np.arange(len(counts) - 1, dtype=np.uint64) if words is None else words
    bits = max(BUCKET_BITS, len(words).bit_length())
    first = np.searchsorted(words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32 if len(words) < 1 << 31 else np.int64)
    order = np.argsort(-counts, kind="stable")
    own = CLASSES // 2
    classes, inputs = np.empty(len(counts), np.uint8), np.empty(len(counts), np.uint16)  # CLASSES and INPUTS fit
    classes[order[:own]] = np.arange(len(order[:own]))
    rest = order[own:]
    weight = np.cumsum(counts[rest] + 1.0)
    classes[rest] = own + np.minimum((weight / weight[-1:] * (CLASSES - own)).astype(np.int64), CLASSES - own - 1)
    plain = INPUTS // 2
    inputs[order[:plain]] = np.arange(len(order[:plain]))
    inputs[order[plain:]] = plain + order[plain:] % (INPUTS - plain - 1)
    smooth = counts + 1.0
    total = np.bincount(classes, smooth, CLASSES)
    return Vocabulary(classes, inputs, np.log(smooth / total[classes]).astype(np.float32), np.log((total + 1) / (total + 1).sum()).astype(np.float32), np.append(words, np.uint64(2**64 - 1)), first)


def new_network(prior: np.ndarray, seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)
    scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return Network((rng.standard_normal((INPUTS, WIDTH)) * 0.3).astype(np.float32), scale(2 * REACH * WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32), scale(HIDDEN, CLASSES) * np.float32(0.1), prior.copy())


def contexts(inputs: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Input ids of the words on both sides of the positions `at`; padding outside their row."""
    row = np.searchsorted(offsets, at, "right") - 1
    first, last = offsets[row], offsets[row + 1]
    out = np.full((len(at), 2 * REACH), INPUTS - 1, np.int64)
    for j, step in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
        there = at + step
        ok = (there >= first) & (there < last)
        out[ok, j] = inputs[there[ok]]
    return out


def _exp(x: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray | float]:
    """exp(x - top), in place, and top: a row's largest value, or 0 where no value is above `most` and that cannot overflow."""
    top = 0.0 if most < SAFE else x.max(axis=1, keepdims=True)
    if most >= SAFE:
        x -= top
    return np.exp(x, out=x), top


def _most(net: Network) -> float:
    """No logit can be larger in magnitude: the hidden layer lies between -1 and 1."""
    return float((np.abs(net.outputs).sum(axis=0) + np.abs(net.bias)).max())


def train(net: Network, context: np.ndarray, target: np.ndarray, memory: list[np.ndarray]) -> float:
    """One gradient step with per-parameter rates, in place; returns the mean loss before it."""
    n = len(target)
    x = net.inputs[context].reshape(n, -1)
    hidden = np.tanh(x @ net.mixing + net.shift)
    d = hidden @ net.outputs
    d += net.bias
    d, _ = _exp(d, _most(net))
    d /= d.sum(axis=1, keepdims=True)
    loss = -float(np.log(np.maximum(d[np.arange(n), target], np.finfo(np.float32).tiny)).mean())
    d[np.arange(n), target] -= 1
    d /= n
    back = (d @ net.outputs.T) * (1 - hidden * hidden)
    back_x = (back @ net.mixing.T).reshape(-1, WIDTH)
    order = np.argsort(context, axis=None, kind="stable")
    ids = context.ravel()[order]
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    ids, rows = ids[starts], np.add.reduceat(back_x[order], starts, axis=0)
    for p, m, g in zip(net[1:], memory[1:], (x.T @ back, back.sum(axis=0), hidden.T @ d, d.sum(axis=0)), strict=True):
        m += g * g
        p -= RATE * g / np.sqrt(m)
    memory[0][ids] += rows * rows
    net.inputs[ids] -= RATE * rows / np.sqrt(memory[0][ids])
    return loss


def hidden_places(hashes: np.ndarray, offsets: np.ndarray, round_: int, every: int) -> np.ndarray:
    """The words to hide in a round: one in `every` of a document, from a place that its first word decides."""
    size = np.diff(offsets)
    begin = np.zeros(len(size), np.int64)
    begin[size > 0] = (hashes[offsets[:-1][size > 0]] >> np.uint64(20)) % np.uint64(every)
    place = np.arange(len(hashes)) - np.repeat(offsets[:-1], size)
    return np.flatnonzero((place + np.repeat(begin, size) + round_) % every == 0)


def _train_task(shared, round_: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = shared_model(shared)
        net, tokens = Network(*(p.copy() for p in start)), Tokenizer(space_table(), SLICE_BYTES)
        memory, seen, held = [np.full_like(p, 1e-4) for p in net], 0, []

        def steps(flush: bool) -> None:
            nonlocal held, seen
            context, target = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            stop = len(target) if flush else len(target) - len(target) % BATCH
            for i in range(0, stop, BATCH):
                train(net, context[i:i + BATCH], target[i:i + BATCH], memory)
            seen, held = seen + stop, [(context[stop:], target[stop:])]

        for batch in batches:
            for w in tokens.slices(batch.column(0)):
                number = numbers_of(vocabulary, w.hashes)
                at = hidden_places(w.hashes, w.offsets, round_, every)
                held.append((contexts(vocabulary.inputs[number], w.offsets, at), vocabulary.classes[number[at]]))
                if sum(len(h[1]) for h in held) >= 64 * BATCH:
                    steps(False)
        if held:
            steps(True)
        flat = np.concatenate([p.ravel() for p in net]).astype(np.float64) * seen
        task = TaskContext.get().partitionId()
        pieces = [flat[i:i + PIECE].tobytes() for i in range(0, len(flat), PIECE)] if seen else []
        n = len(pieces)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, task), pa.int64()), pa.array(np.full(n, seen), pa.int64()), pa.array(pieces, pa.binary())], names=["piece", "task", "seen", "sum"])

    return run


def _sum_pieces(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.float64) for x in table["sum"].to_pylist()], axis=0)
    return pa.table({"piece": table["piece"].slice(0, 1), "task": pa.array([table["task"][0].as_py() // FAN_IN], pa.int64()), "seen": pa.array([sum(table["seen"].to_pylist())], pa.int64()), "sum": pa.array([total.tobytes()], pa.binary())})


def fit(docs: DataFrame, rounds: int = ROUNDS, mask_every: int = MASK_EVERY) -> tuple[Vocabulary, Network]:
    """Count and train over all of `docs` (text); the driver holds one set of parameters (0.3 MB) and the counts of the distinct words."""
    docs = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words, counts = count_words(docs)
    vocabulary = build_vocabulary(np.append(counts, 0), words)
    net = new_network(vocabulary.prior)
    for r in range(rounds):
        shared = share(docs, vocabulary, net)
        sums = docs.mapInArrow(_train_task(shared, r, mask_every), "piece int, task bigint, seen bigint, sum binary")
        for _ in range(LEVELS):  # tasks 0 to FAN_IN - 1 meet first, then the sums of as many
            sums = sums.groupBy("piece", F.floor(F.col("task") / FAN_IN).alias("over")).applyInArrow(_sum_pieces, "piece int, task bigint, seen bigint, sum binary")
        rows = sorted(sums.collect(), key=lambda x: x["piece"])
        shared.destroy()
        if not rows:
            break
        flat, at, new = np.concatenate([np.frombuffer(x["sum"], np.float64) for x in rows]) / rows[0]["seen"], 0, []
        for p in net:
            new.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        net = Network(*new)
    return vocabulary, net


def log_probabilities(vocabulary: Vocabulary, net: Network, bucket: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log P(word | both sides) of each word."""
    inputs, out = vocabulary.inputs[bucket], np.empty(len(bucket), np.float64)
    # the first layer is linear in each neighbour, so it is a sum of looked-up rows
    tables, most, ones = [net.inputs @ net.mixing[j * WIDTH:(j + 1) * WIDTH] for j in range(2 * REACH)], _most(net), np.ones(CLASSES, np.float32)
    for i in range(0, len(bucket), SCORE_ROWS):
        at = np.arange(i, min(i + SCORE_ROWS, len(bucket)))
        context = contexts(inputs, offsets, at)
        hidden = tables[0][context[:, 0]]
        for j in range(1, 2 * REACH):
            hidden += tables[j][context[:, j]]
        hidden += net.shift
        logits = np.tanh(hidden, out=hidden) @ net.outputs
        logits += net.bias
        target = logits[np.arange(len(at)), vocabulary.classes[bucket[at]]]
        each, top = _exp(logits, most)
        out[at] = target - np.ravel(top) - np.log(each @ ones) + vocabulary.within[bucket[at]]
    return out


def score(docs: DataFrame, model: tuple[Vocabulary, Network]) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) for every row of `docs` (doc_id, text); other columns are ignored.

    `log_prob` sums over all words `[^\\x20\\x09-\\x0D]+` of the whole text. Null, empty and blank texts have no
    words, log_prob 0 and a null mean. Repeated rows score alike; an empty table gives an empty result.
    """
    shared = share(docs, *model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (vocabulary, net), tokens = shared_model(shared), Tokenizer(space_table(), SLICE_BYTES)
        for batch in batches:
            n, total = [np.empty(0, np.int64)], [np.empty(0)]
            for w in tokens.slices(batch.column(1)):
                each = log_probabilities(vocabulary, net, numbers_of(vocabulary, w.hashes), w.offsets)
                n.append(np.diff(w.offsets))
                total.append(np.diff(np.concatenate([[0], np.cumsum(each)])[w.offsets]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n), pa.int64()), pa.array(np.concatenate(total))], names=["doc_id", "n_words", "log_prob"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.mapInArrow(run, "doc_id bigint, n_words bigint, log_prob double")
    return found.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))
