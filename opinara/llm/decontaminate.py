"""Benchmark passages in documents, by edit distance over words.

A document holds an item of m words if some run of its words is within `max_edit` * m edits
(insertions, deletions, substitutions of words) of the item. An item with at most e edits is cut into
e + 1 pieces, of which no edit touches at least one, wherever the edits lie. Candidates come from CGK
embeddings of these pieces: a random walk reads a word at each step and moves on or stays, as a random
bit of the step and the word decides. It takes as many steps as a piece has words, so it cannot leave
the piece, and an untouched piece always reads the same words in the document as in the item: no match
is lost, at any length. `tables` walks, each of which hashes the words read at `samples` steps,
have to agree; more of them only rule out more.

Walks start at every word of every document and at the first word of every piece. Pieces are
grouped by length. Before that, places are ruled out whose neighbouring words are neighbours
in no item, and after it surroundings that hold too few words, or pairs of neighbouring words, of any
item to match (an edit changes one word and two pairs at most); no match is lost to this either. What is
left is compared exactly, at every start that the untouched piece allows.

Words are lower-cased runs of letters and digits; any other byte than ASCII counts as a letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import fresh, share, shared_value
from opinara.llm.tokens import Tokenizer, mix, non_word_table

TABLES, SAMPLES, MAX_EDIT = 32, 3, 0.2
MAX_PIECE = 16  # words of a piece that are walked; longer pieces are known by their first ones
ITEM_BYTES = 16 << 20  # text of the items that are broadcast at once
VERIFY_CELLS = 4_000_000
HITS = 1_000_000  # candidates that are expanded at once


class Group(NamedTuple):
    """Pieces of equal length."""

    moves: np.ndarray  # tables x steps: odd factors whose top bit moves the walk
    picks: np.ndarray  # tables x samples: steps whose words are hashed
    keys: np.ndarray  # the sorted hashes of the pieces
    owners: np.ndarray  # their items
    places: np.ndarray  # and their first words in them


class Items(NamedTuple):
    ids: list[int | None]
    words: list[np.ndarray]
    edits: np.ndarray
    vocabulary: np.ndarray
    pairs: np.ndarray
    groups: list[Group]


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    tokens = Tokenizer(non_word_table())
    out = []
    for w in tokens.slices(pc.utf8_lower(pa.array(texts, pa.large_string()))):
        out += [w.hashes[a:b] for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)]
    return out


def word_pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:])


def walk_keys(words: np.ndarray, starts: np.ndarray, moves: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The hash of the words that the walks of all tables read at `picks` from each start; a walk reads as many words as it has steps at most."""
    key = np.zeros(len(starts), np.uint64)
    for move, pick in zip(moves, picks, strict=True):
        at = starts.copy()
        for step in range(pick.max() + 1):
            word = words[at]
            for _ in range(int((pick == step).sum())):
                key = (key ^ word) * np.uint64(0x9FB21C651E98DF25)
                key ^= key >> np.uint64(29)
            at += (word * move[step] >> np.uint64(63)).astype(np.int64)
    return mix(key)


def index_items(ids: list[int | None], texts: list[str | None], max_edit: float = MAX_EDIT, tables: int = TABLES, samples: int = SAMPLES, seed: int = 5) -> Items:
    if not 0 <= max_edit < 1:
        raise ValueError("max_edit must be at least 0 and below 1")
    rows = [(i, w) for i, w in zip(ids, word_hashes(texts), strict=True) if len(w)]
    ids, words = [r[0] for r in rows], [r[1] for r in rows]
    lengths = np.array([len(w) for w in words], np.int64)
    edits = np.floor(lengths * max_edit + 1e-9).astype(np.int64)
    size, rng = np.minimum(lengths // (edits + 1), MAX_PIECE), np.random.default_rng(seed)
    flat, first, groups = np.concatenate(words) if words else np.empty(0, np.uint64), np.cumsum(lengths) - lengths, []
    for steps in np.unique(size).tolist():
        moves = rng.integers(0, 1 << 63, (tables, steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        picks = np.sort(rng.integers(0, steps, (tables, samples)), axis=1)
        mine = np.flatnonzero(size == steps)
        owners = np.repeat(mine, edits[mine] + 1)
        number = np.arange(len(owners)) - np.repeat(np.cumsum(edits[mine] + 1) - edits[mine] - 1, edits[mine] + 1)
        places = number * lengths[owners] // (edits[owners] + 1)
        key = walk_keys(flat, first[owners] + places, moves, picks)
        order = np.argsort(key, kind="stable")
        groups.append(Group(moves, picks, key[order], owners[order], places[order]))
    vocabulary = np.unique(flat)
    pairs = np.unique(np.concatenate([word_pairs(w) for w in words])) if words else vocabulary
    return Items(ids, words, edits, vocabulary, pairs, groups)


def prefix_edits(item: np.ndarray, windows: np.ndarray, anywhere: bool = False) -> np.ndarray:
    """The least edits from `item` to the words of each row of `windows` before each place; from the row's beginning, or from `anywhere` in it."""
    width = windows.shape[1]
    steps = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((len(windows), width + 1), np.int32) if anywhere else np.broadcast_to(steps, (len(windows), width + 1)).copy()
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (windows != word), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row


def _in_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def matches(words: np.ndarray, offsets: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    """(row, item, edits, start, words) of the best match of each row and item: fewest edits, then first."""
    n = len(words)
    if not n or not items.groups:
        return []
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    known = np.concatenate([[0], np.cumsum(_in_sorted(words, items.vocabulary))])
    known_pairs = np.concatenate([[0], np.cumsum(_in_sorted(word_pairs(words), items.pairs)), [0]])
    known_pairs[-1] = known_pairs[-2]
    lengths = np.array([len(w) for w in items.words], np.int64)
    place, regions = np.arange(n), []
    for g in items.groups:
        steps = g.moves.shape[1]
        stop = np.minimum(place + steps, n)
        starts = np.flatnonzero((place + steps <= offsets[1:][row_of]) & (known[stop] - known[place] == steps) & (known_pairs[stop - 1] - known_pairs[place] == steps - 1))
        if not len(starts):
            continue
        key = walk_keys(words, starts, g.moves, g.picks)
        low = np.searchsorted(g.keys, key)
        count = np.searchsorted(g.keys, key, "right") - low
        hit = np.flatnonzero(count)
        total = np.cumsum(count[hit])
        i = 0
        while i < len(hit):  # so many that they fit into memory, one at least
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + HITS, "right")))
            times = count[hit[i:j]]
            at = np.repeat(low[hit[i:j]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            start, item = np.repeat(starts[hit[i:j]], times), g.owners[at]
            i = j
            row, e, m = row_of[start], items.edits[item], lengths[item]
            # a match that leaves the piece untouched starts at most e words before or after this place of its row; e + 1 neighbouring places share a region
            region = (start - offsets[row] - g.places[at]) // (e + 1)
            first = region * (e + 1) - e
            from_, to = offsets[row] + np.maximum(first, 0), np.clip(offsets[row] + first + m + 4 * e, offsets[row], offsets[row + 1])
            enough = (to - from_ >= m - e) & (known[to] - known[from_] >= m - e) & (known_pairs[np.maximum(to - 1, from_)] - known_pairs[from_] >= m - 1 - 2 * e)
            regions.append(np.unique(np.stack([item, row, region], 1)[enough], axis=0))
    if not regions:
        return []
    regions = np.unique(np.concatenate(regions), axis=0)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    cuts = np.flatnonzero(np.concatenate([[True], regions[1:, 0] != regions[:-1, 0], [True]])) if len(regions) else np.zeros(1, np.int64)
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        item = int(regions[i, 0])
        wanted, e = items.words[item], int(items.edits[item])
        width = len(wanted) + 4 * e
        step = max(1, VERIFY_CELLS // (width + 1))
        for a in range(i, j, step):
            row = regions[a:min(a + step, j), 1]
            first = offsets[row] + regions[a:min(a + step, j), 2] * (e + 1) - e
            index = first[:, None] + np.arange(width)
            inside = (index >= offsets[row][:, None]) & (index < offsets[row + 1][:, None])
            windows = np.where(inside, words[np.clip(index, 0, n - 1)], np.uint64(0))  # no word hashes to 0 in practice
            # from the end backwards: the least edits of a match that starts at each word
            edits = np.where(inside, prefix_edits(wanted[::-1], windows[:, ::-1], True)[:, :0:-1], len(wanted) + 1)
            at = edits.argmin(axis=1)  # the first start
            for k in np.flatnonzero(edits[np.arange(len(row)), at] <= e):
                found = (int(edits[k, at[k]]), int(index[k, at[k]] - offsets[row[k]]))
                if (int(row[k]), item) not in best or found < best[int(row[k]), item][:2]:
                    start = int(index[k, at[k]])
                    ahead = prefix_edits(wanted, words[None, start:min(start + len(wanted) + e, int(offsets[row[k] + 1]))])[0]
                    best[int(row[k]), item] = (*found, int(ahead.argmin()))
    return [(row, item, *found) for (row, item), found in sorted(best.items())]


def _search(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, tokens = shared_value(shared), Tokenizer(non_word_table())
        for batch in batches:
            rows = []
            for w in tokens.slices(pc.utf8_lower(batch.column(2).cast(pa.large_string()))):
                rows += [(w.first + r, item, e, s, m) for r, item, e, s, m in matches(w.hashes, w.offsets, items)]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), batch.column(1).take(at), pa.array([items.ids[r[1]] for r in rows], pa.int64()), pa.array([len(items.words[r[1]]) for r in rows], pa.int32()),
                *(pa.array([r[i] for r in rows], pa.int32()) for i in (2, 3, 4))], names=["doc_id", "text_key", "item_id", "item_words", "edits", "start", "words"])

    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT, tables: int = TABLES, samples: int = SAMPLES) -> DataFrame:
    """One row per row of `docs` (doc_id, text) and item of `benchmark` (item_id, text) it holds:
    doc_id, text_key (xxhash64 of the text), item_id, item_words, edits, start (first word, from 0) and words of the best match.

    Null, empty and wordless texts and items match nothing; items with a null item_id are searched like others. Items
    that share an item_id, also the null one, are searched as separate rows; repeated documents are found alike. Empty tables give an empty result; other
    columns are ignored. Items are broadcast, 16 MB of text at a time; a larger benchmark is searched in several passes.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    passes = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = None
    for i in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i).orderBy("item_id", "text").collect()
        shared = share(spark, index_items([r["item_id"] for r in part], [r["text"] for r in part], max_edit, tables, samples))
        found = texts.mapInArrow(_search(shared), "doc_id bigint, text_key bigint, item_id bigint, item_words int, edits int, start int, words int")
        out = found if out is None else out.union(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, max_edit: float = MAX_EDIT) -> DataFrame:
    """`docs` without the documents that hold a benchmark item; all columns are kept."""
    i, k = fresh(docs, "leak_id"), fresh(docs, "leak_key")
    leaks = find_leaks(docs, benchmark, max_edit).select(F.col("doc_id").alias(i), F.col("text_key").alias(k)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(docs["text"].cast("string")) == F.col(k))
    return docs.join(leaks, same, "left_anti")
