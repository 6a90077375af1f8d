"""Language identification with hyperdimensional letter profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram's vector binds
(multiplies) its letters' vectors, each permuted by its place; a text's profile bundles (adds)
the vectors of its trigrams, and so does a language's prototype over all of its texts. The
language whose prototype has the largest cosine with the profile is predicted.

Letters are lower-cased; everything else is one boundary symbol between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
DIMENSIONS, SEED = 1024, 7
SLICE_CHARS = 1 << 18  # characters that are spread out into arrays at once
PASS_BYTES = 4 << 20  # rows that are handed on at once
STEP = 2048  # trigrams that are bound at once
HELD_CODES = 500_000  # trigram counts that a task holds before it binds them
TABLE = 1 << 22  # trigram codes that are looked up in a table; more are sorted
MAX_LANGUAGES = 10_000


def letter_vector(point: int, dimensions: int, seed: int = SEED) -> np.ndarray:
    """The letter's random signs; code point 0 stands for a boundary."""
    bits = np.random.Generator(np.random.Philox(key=[seed, point])).integers(0, 2, dimensions, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def letter_table() -> np.ndarray:
    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 0
    return np.char.isalpha(points.view("U1"))


class Trigrams:
    """Trigram counts of texts and the trigrams' vectors; vectors are kept between calls."""

    def __init__(self, dimensions: int):
        self.dimensions, self.is_letter = dimensions, letter_table()
        self.letters: dict[int, np.ndarray] = {}
        self.codes, self.vectors = np.empty(0, np.uint64), np.empty((0, dimensions), np.int8)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            self.letters[point] = letter_vector(point, self.dimensions)
        return self.letters[point]

    def bind(self, codes: np.ndarray) -> np.ndarray:
        """One row for each (sorted) code of three 21-bit code points."""
        new = np.setdiff1d(codes, self.codes, assume_unique=True)
        if len(new):
            if len(self.codes) + len(new) > 20_000:  # keeps memory bounded for very large alphabets
                self.codes, self.vectors, new = self.codes[:0], self.vectors[:0], codes
            made = np.empty((len(new), self.dimensions), np.int8)
            for i, code in enumerate(new.tolist()):
                a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
                made[i] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
            order = np.argsort(np.concatenate([self.codes, new]), kind="stable")
            self.codes, self.vectors = np.concatenate([self.codes, new])[order], np.concatenate([self.vectors, made])[order]
        return self.vectors[np.searchsorted(self.codes, codes)].astype(np.float32)

    def counts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(codes, counts of each row) for consecutive rows of a text column."""
        ends = np.cumsum(np.asarray(pc.fill_null(pc.utf8_length(column), 0), np.int64))
        i = 0
        while i < len(column):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE_CHARS, "right")))
            part = pc.utf8_lower(pc.fill_null(column.slice(i, j - i), "")).to_pylist()
            joined = "\n" + "\n".join(part) + "\n"
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            row = np.repeat(np.arange(len(part), dtype=np.int32), [len(t) + 1 for t in part])
            letter = self.is_letter[points]
            at = np.flatnonzero(letter)
            alphabet, small = np.unique(points[at], return_inverse=True)
            symbol = np.zeros(len(points), np.int64)
            symbol[at] = small + 1
            size = len(alphabet) + 1
            symbol = symbol.astype(np.int32) if size ** 3 <= TABLE else symbol
            code = (symbol[at - 1] * size + symbol[at]) * size + symbol[at + 1]
            if size ** 3 <= TABLE:
                present = np.flatnonzero(np.bincount(code, minlength=size ** 3))
                place = np.zeros(size ** 3, np.int32)
                place[present] = np.arange(len(present))
                place = place[code]
            else:
                present, place = np.unique(code, return_inverse=True)
            full = np.concatenate([[0], alphabet]).astype(np.uint64)
            codes = full[present // (size * size)] << np.uint64(42) | full[present // size % size] << np.uint64(21) | full[present % size]
            order = np.argsort(codes)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            rows = row[at - 1]
            step = max(1, 8_000_000 // max(len(codes), 1))
            for a in range(0, len(part), step):
                b = min(a + step, len(part))
                lo, hi = np.searchsorted(rows, a), np.searchsorted(rows, b)
                flat = (rows[lo:hi] - a).astype(np.int64) * len(codes) + rank[place[lo:hi]]
                yield codes[order], np.bincount(flat, minlength=(b - a) * len(codes)).reshape(b - a, len(codes)).astype(np.float32)
            i = j

    def profiles(self, column: pa.Array) -> Iterator[np.ndarray]:
        for codes, counts in self.counts(column):
            total = np.zeros((len(counts), self.dimensions), np.float32)
            for i in range(0, len(codes), STEP):
                total += counts[:, i:i + STEP] @ self.bind(codes[i:i + STEP])
            yield total


def _bundles(dimensions: int):
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = Trigrams(dimensions), {}
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}  # trigram counts of a language that are not bound yet

        def bind() -> None:
            for x, parts in held.items():
                codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([n for _, n in parts]), len(codes))
                for i in range(0, len(codes), STEP):
                    sums[x] = sums.get(x, 0) + counts[i:i + STEP] @ grams.bind(codes[i:i + STEP])
            held.clear()

        n = 0
        for batch in batches:
            langs, start = np.array(batch.column(1).to_pylist(), object), 0
            for codes, counts in grams.counts(batch.column(0)):
                here = langs[start:start + len(counts)]
                start += len(counts)
                for x in set(here):
                    total = counts[here == x].sum(axis=0, dtype=np.float64)
                    some = np.flatnonzero(total)
                    held.setdefault(x, []).append((codes[some], total[some]))
                    n += len(some)
                if n > HELD_CODES:
                    bind()
                    n = 0
        bind()
        names = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[x] for x in names], pa.list_(pa.float64()))], names=["lang", "v"])

    return bundle


def fit(docs: DataFrame, learn: Column, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototypes of all languages in the rows of `docs` (doc_id, text, lang) for which `learn` holds; null lang is left out.

    The driver holds one vector for each language; more than `MAX_LANGUAGES` values raise.
    """
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = rows.mapInArrow(_bundles(dimensions), "lang string, v array<double>").select("lang", F.posexplode("v").alias("at", "v")) \
        .groupBy("lang", "at").agg(F.sum(F.floor("v")).alias("v"))
    found = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array(r["v"], np.float64) for r in found}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """All columns of `docs` plus lang_pred and score; input columns of these names are replaced.

    `score` is the cosine with the predicted language's prototype, 0 at least; ties go to the smaller name.
    A null text, or one without a letter, is `und` with score 0, as is every text if nothing was
    learned. Repeated rows are predicted alike; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    names = sorted(n for n, v in prototypes.items() if v.any())
    matrix = np.stack([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names], 1).astype(np.float32) if names else np.zeros((DIMENSIONS, 0), np.float32)
    names, schema = np.array([*names, UNKNOWN], object), docs.select(*(f"`{c}`" for c in kept)).schema
    at = [c.lower() for c in kept].index("text")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The batches, cut by the bytes of their texts."""
        for batch in batches:
            ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0), np.int64))
            i = 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PASS_BYTES, "right")))
                yield batch.slice(i, j - i)
                i = j

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Trigrams(len(matrix))
        for batch in parts(batches):
            best, scores = [], []
            for x in grams.profiles(batch.column(at)):
                length = np.linalg.norm(x, axis=1)
                if not matrix.shape[1]:
                    length[:] = 0
                cosine = np.zeros((len(x), 1)) if not matrix.shape[1] else x @ matrix / np.where(length > 0, length, 1)[:, None]
                best.append(np.where(length > 0, cosine.argmax(axis=1), len(names) - 1))
                scores.append(np.where(length > 0, np.clip(cosine.max(axis=1), 0, 1), 0))
            best, scores = (np.concatenate(z) if z else np.empty(0, k) for z, k in ((best, np.int64), (scores, np.float64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[best.astype(np.int64)].tolist(), pa.string()), pa.array(scores.astype(np.float64))], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.select(*(f"`{c}`" for c in kept)).mapInArrow(predict, schema.add("lang_pred", "string").add("score", "double"))
