"""Removal of long repeated word sequences.

Every `window` consecutive words of a document are an edge of a De Bruijn graph
(its nodes are the runs of `window - 1` words). An edge that occurs again
removes the words of each occurrence but the first. The graph is far larger than
its repeated part, so only that part is found, by two joins:

1. Documents are dealt into blocks by hash. Equal windows hold an equal smallest
   `seed`-word hash; each block sends its distinct seeds (about one per eight words)
   to a join that tells it which seeds other blocks hold too.
2. Windows over repeated seeds are the candidate edges. A block sends each distinct
   edge once, with its first coordinate, so a passage that a third of all documents
   hold costs one row for each block. The join answers with the first coordinate of all.
3. Each block marks the occurrences that have an earlier one. Neighbouring edges
   whose first occurrences are neighbours too become one span (start, words, source document,
   source start), by merging runs inside the document's task.

Edges are compared by two 64-bit hashes, both made from the same 64-bit hash of each word; words
are not compared with their source.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.tokens import Tokenizer, mix, sliding, space_table, window_hashes, windows_inside

FIRST, SECOND = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
BLOCK_BYTES = 16 << 20

SPAN = "array<struct<start:int,words:int,source_doc:bigint,source_start:int>>"
MESSAGE = "bucket int, block int, kind int, base bigint, a binary, b binary, doc binary, start binary"
MESSAGE_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("base", pa.int64()), *((c, pa.binary()) for c in ("a", "b", "doc", "start"))])


def _message(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(MESSAGE_ARROW)], schema=MESSAGE_ARROW)


def _join(column: pa.ChunkedArray, kind) -> np.ndarray:
    parts = [np.frombuffer(x, kind) for x in column.to_pylist() if x]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _in_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class _Block:
    """Word windows of a block's documents, slice by slice."""

    def __init__(self, table: pa.Table, window: int, seed: int):
        self.docs = np.array([-(1 << 63) if x is None else x for x in table["doc_id"].to_pylist()], np.int64)
        self.text, self.window, self.seed = table["text"], window, seed
        self.tokens = Tokenizer(space_table())

    def slices(self):
        for w in self.tokens.slices(self.text):
            ok = windows_inside(w.offsets, self.window, len(w.hashes))[:max(len(w.hashes) - self.window + 1, 0)]
            yield w, ok

    def seeds_of(self, w, ok):
        """The seed of each window (mixed 0 where there is none), and the seeds chosen at each place.

        Least hashes are small numbers; mixed again they spread evenly over buckets."""
        span = self.window - self.seed + 1
        grams = window_hashes(w.hashes, self.seed, FIRST) | np.uint64(1)
        least = np.where(ok, sliding(grams, span, np.minimum), np.uint64(0))
        padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
        chosen = grams[sliding(padded, span, np.maximum)[:len(grams)] == grams] if len(least) else grams[:0]
        return mix(least), mix(chosen)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct seeds, and how often each was chosen."""
        chosen = [self.seeds_of(w, ok)[1] for w, ok in self.slices()]
        return np.unique(np.concatenate(chosen), return_counts=True) if chosen else (np.empty(0, np.uint64), np.empty(0, np.int64))

    def edges(self, elsewhere: np.ndarray):
        """Candidate windows as arrays: hash, hash, document, start, row, sorted by edge and place."""
        values, counts = self.seeds()
        known = np.union1d(elsewhere, values[counts > 1])
        out = []
        for w, ok in self.slices():
            least, _ = self.seeds_of(w, ok)
            if not len(least):
                continue
            cut = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            hit = np.repeat(_in_sorted(least[cut], known), np.diff(np.append(cut, len(least)))) & ok
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            row = np.searchsorted(w.offsets, at, "right") - 1
            a, b = (window_hashes(w.hashes, self.window, base)[at] for base in (FIRST, SECOND))
            out.append((a, b, self.docs[w.first + row], (at - w.offsets[row]).astype(np.int32), (w.first + row).astype(np.int32)))
        kinds = (np.uint64, np.uint64, np.int64, np.int32, np.int32)
        cols = [np.concatenate([o[i] for o in out]) if out else np.empty(0, k) for i, k in enumerate(kinds)]
        order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
        return [c[order] for c in cols]


def _heads(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a new edge begins in sorted arrays."""
    if not len(a):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))


def _to_buckets(bucket: np.ndarray, n: int):
    """Ranges of equal bucket in an array that is sorted by it."""
    cuts = np.searchsorted(bucket, np.arange(n + 1))
    return [(k, cuts[k], cuts[k + 1]) for k in range(n) if cuts[k] < cuts[k + 1]]


def _bucket(a: np.ndarray, n: int) -> np.ndarray:
    """Buckets are ranges of the hash, so sorted hashes have sorted buckets."""
    return ((a >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _send_seeds(window: int, seed: int, n: int):
    def send(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        values, _ = _Block(table, window, seed).seeds()
        return _message([(k, block, 0, 0, values[i:j].tobytes(), None, None, None) for k, i, j in _to_buckets(_bucket(values, n), n)])

    return send


def _answer_seeds(table: pa.Table) -> pa.Table:
    """To each block those of its seeds that another block sent too."""
    blocks, parts = table["block"].to_pylist(), [np.frombuffer(x, np.uint64) for x in table["a"].to_pylist()]
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    values = values[counts > 1]
    found = ((b, p[_in_sorted(p, values)]) for b, p in zip(blocks, parts, strict=True))
    return _message([(0, b, 1, 0, p.tobytes(), None, None, None) for b, p in found if len(p)])


def _send_edges(window: int, seed: int, n: int):
    def send(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _message([])
        block = docs["block"][0].as_py()
        a, b, doc, start, _ = _Block(docs, window, seed).edges(np.unique(_join(told["a"], np.uint64)))
        at = _heads(a, b)
        a, b, doc, start = a[at], b[at], doc[at], start[at]
        return _message([(k, block, 2, i, a[i:j].tobytes(), b[i:j].tobytes(), doc[i:j].tobytes(), start[i:j].tobytes()) for k, i, j in _to_buckets(_bucket(a, n), n)])

    return send


def _answer_edges(table: pa.Table) -> pa.Table:
    """To each block the edges that occur earlier in another, as places in its own list, with that first coordinate."""
    blocks, bases = table["block"].to_pylist(), table["base"].to_pylist()
    sizes = [len(x) // 8 for x in table["a"].to_pylist()]
    a, b, doc, start = (_join(table[c], k) for c, k in (("a", np.uint64), ("b", np.uint64), ("doc", np.int64), ("start", np.int32)))
    sent = np.repeat(np.arange(len(sizes)), sizes)
    place = np.concatenate([np.arange(x) + y for x, y in zip(sizes, bases, strict=True)])
    order = np.lexsort((start, doc, b, a))
    a, b, doc, start, sent, place = (x[order] for x in (a, b, doc, start, sent, place))
    at = _heads(a, b)
    first = np.repeat(at, np.diff(np.append(at, len(a))))
    later = np.flatnonzero((doc > doc[first]) | (start > start[first]) & (doc == doc[first]))
    later = later[np.argsort(sent[later], kind="stable")]
    cuts = np.searchsorted(sent[later], np.arange(len(sizes) + 1))
    rows = []
    for k in range(len(sizes)):
        x = later[cuts[k]:cuts[k + 1]]
        if len(x):
            rows.append((0, blocks[k], 3, 0, place[x].astype(np.uint32).tobytes(), None, doc[first[x]].tobytes(), start[first[x]].tobytes()))
    return _message(rows)


def _finish(window: int, seed: int, keep_text: bool):
    def finish(docs: pa.Table, told: pa.Table) -> pa.Table:
        ids, texts = docs["doc_id"].to_pylist(), docs["text"]
        n, marks = len(ids), [[] for _ in ids]
        kinds = np.array(told["kind"].to_pylist(), np.int64)
        seeds, firsts = (told.filter(pa.array(kinds == k)) for k in (1, 3))
        if n:
            a, b, doc, start, row = _Block(docs, window, seed).edges(np.unique(_join(seeds["a"], np.uint64)))
            at = _heads(a, b)
            source_doc, source_start = doc[at], start[at]
            place = _join(firsts["a"], np.uint32)
            source_doc[place], source_start[place] = _join(firsts["doc"], np.int64), _join(firsts["start"], np.int32)
            edge = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(a))))
            again = np.flatnonzero((doc > source_doc[edge]) | (start > source_start[edge]) & (doc == source_doc[edge]))
            again = again[np.lexsort((start[again], row[again]))]
            row, start, source_doc, source_start = row[again], start[again], source_doc[edge[again]], source_start[edge[again]]
            if len(again):  # nonbranching paths: the next edge here is the next edge at the source
                same = (row[1:] == row[:-1]) & (start[1:] == start[:-1] + 1) & (source_doc[1:] == source_doc[:-1]) & (source_start[1:] == source_start[:-1] + 1)
                path = np.flatnonzero(np.concatenate([[True], ~same]))
                length = np.diff(np.append(path, len(row))) + window - 1
                for r, *span in zip(row[path].tolist(), start[path].tolist(), length.tolist(), source_doc[path].tolist(), source_start[path].tolist(), strict=True):
                    marks[r].append(span)
        counts, removed, digests, kept_texts = [], [], [], []
        for i in range(n):
            words = (texts[i].as_py() or "").encode("utf-8", "surrogatepass").split()
            counts.append(len(words))
            if marks[i]:
                keep = np.ones(len(words), bool)
                for s, m, _, _ in marks[i]:
                    keep[s:s + m] = False
                words = list(compress(words, keep.tolist()))
            removed.append(counts[-1] - len(words))
            kept = b" ".join(words)
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept.decode("utf-8", "surrogatepass") if keep_text else None)
        spans = [[{"start": s, "words": m, "source_doc": d, "source_start": x} for s, m, d, x in each] for each in marks]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source_doc", pa.int64()), ("source_start", pa.int32())]))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, kind), "kept_text": pa.array(kept_texts, pa.string())})

    return finish


def remove_repeated_spans(docs: DataFrame, window: int = 20, seed: int = 6, keep_text: bool = True, blocks: int | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id long, text string): doc_id, n_words, n_removed, kept_sha256, spans, kept_text.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A word goes if some `window` words that
    cover it also start earlier: in a smaller doc_id, or earlier in the same document.
    `spans` are the removed paths with the coordinates of their first occurrence;
    `kept_text` (null unless `keep_text`) is the kept words joined by one space.

    Null and empty texts have no words. A null doc_id counts as the smallest. Rows that
    share a doc_id share coordinates, so neither of two repeated rows precedes the other
    and both stay. Other columns are ignored. `blocks` defaults to one per 16 MB of text,
    and at least the session's shuffle partitions.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if blocks is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(blocks)).cast("int")
    dealt = docs.withColumn("block", block).repartition(blocks, "block")
    by_block = dealt.groupBy("block")
    sent = by_block.applyInArrow(_send_seeds(window, seed, blocks), MESSAGE)
    seeds = sent.repartition(blocks, "bucket").groupBy("bucket").applyInArrow(_answer_seeds, MESSAGE).repartition(blocks, "block")
    edges = by_block.cogroup(seeds.groupBy("block")).applyInArrow(_send_edges(window, seed, blocks), MESSAGE)
    firsts = edges.repartition(blocks, "bucket").groupBy("bucket").applyInArrow(_answer_edges, MESSAGE)
    told = seeds.union(firsts).groupBy("block")
    return by_block.cogroup(told).applyInArrow(
        _finish(window, seed, keep_text), f"doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans {SPAN}, kept_text string")
