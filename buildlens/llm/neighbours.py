"""Quality by votes of the nearest marked texts in a latent-semantic space.

A text's terms are its words (without case and punctuation), the shapes of its blank-separated
words, and bands of a few ratios (distinct words, words equal to the one before, words seen in a
run before). Terms are hashed to ``WIDTH`` places, weighted by log frequency and inverse document
frequency, and projected on the leading singular vectors of a bounded sample of marked texts.
The sample's vectors are broadcast, and every text's exact cosines with all of them are computed
in blocks; the nearest ``NEAREST`` vote for their marks, weighted by a power of similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import bounded, per_text, raw, share_of, slices, trimmed, words

#: Marked rows that are kept as voters, for each of the two marks on average, and the longest of their texts in bytes.
TRAIN_ROWS = 2000
TRAIN_BYTES = 100_000
#: Places for words, for shapes, and for bands of ratios.
WORD_PLACES, SHAPE_PLACES, BAND_PLACES = 1024, 1024, 64
WIDTH = WORD_PLACES + SHAPE_PLACES + BAND_PLACES
#: Weight of each block of terms, whose vectors have unit length on their own.
WEIGHTS = (0.35, 1.0, 1.0)
DIMENSIONS = 48
NEAREST = 25
POWER = 8
THRESHOLD = 0.3
SLICE = 4 << 20
#: Texts whose cosines are computed at once.
BLOCK = 512

#: Letters, capitals and digits as one character each; bytes of other scripts count as letters.
SHAPE = bytes(
    0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x39 if 0x30 <= b <= 0x39 else b for b in range(256)
)
RUN = re.compile(rb"(.)\1+")
EDGE = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def places(word: bytes) -> tuple[int, int]:
    """Places of a word and of its shape."""
    return crc32(word.strip(EDGE).lower()) % WORD_PLACES, WORD_PLACES + crc32(RUN.sub(rb"\1", word.translate(SHAPE))) % SHAPE_PLACES


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, weight) by text and place: log frequencies of a slice's terms."""
    data, off = raw(texts)
    codes, distinct, counts = words(data, off)
    n = len(counts)
    text = np.repeat(np.arange(n), counts)
    place = np.array([places(w) for w in distinct.to_pylist()], np.int64).reshape(-1, 2)
    keys = np.concatenate([text * WIDTH + place[codes, 0], text * WIDTH + place[codes, 1]])
    keys, many = np.unique(keys, return_counts=True)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    # bands of ratios, each as one term
    pairs = np.unique(text * max(1, len(distinct)) + codes) // max(1, len(distinct))
    kinds = np.bincount(pairs, minlength=n)
    same = np.zeros(len(codes), np.int64)
    same[1:] = (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])
    again = np.zeros(len(codes), np.int64)
    if len(codes) > 3:
        _, two = np.unique(codes[:-2] * max(1, len(distinct)) + codes[1:-1], return_inverse=True)
        run = two * max(1, len(distinct)) + codes[2:]
        order = np.lexsort((run, text[:-2]))
        repeated = (run[order][1:] == run[order][:-1]) & (text[:-2][order][1:] == text[:-2][order][:-1])
        again[order[1:][repeated]] = 1
    size = np.maximum(counts, 1)
    length = np.minimum(np.log2(size).astype(np.int64), 15)
    ratios = [np.log2(size / np.maximum(kinds, 1)), 8 * per_text(same, bounds) / size, 8 * per_text(again, bounds) / size]
    bands = [WORD_PLACES + SHAPE_PLACES + 16 * (k + 1) + np.clip(np.round(2 * r), 0, 15).astype(np.int64) for k, r in enumerate(ratios)]
    own = np.arange(n)
    extra = np.concatenate([own * WIDTH + b for b in (WORD_PLACES + SHAPE_PLACES + length, *bands)])
    keys, many = np.concatenate([keys, extra]), np.concatenate([np.log1p(many), np.tile([0.5, 1.0, 1.5, 1.5], (n, 1)).T.ravel()])
    order = np.argsort(keys, kind="stable")
    return keys[order] // WIDTH, keys[order] % WIDTH, many[order]


def weighted(text: np.ndarray, place: np.ndarray, weight: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """Weights times idf, each block of each text scaled to its share of unit length."""
    weight = weight * idf[place]
    block = text * 3 + (place >= WORD_PLACES) + (place >= WORD_PLACES + SHAPE_PLACES)
    norm = np.sqrt(np.bincount(block, weight**2, 3 * n))
    return weight / np.maximum(norm, 1e-12)[block] * np.array(WEIGHTS)[block % 3]


@dataclass
class Voters:
    """Inverse document frequencies, projection, and the marked texts' unit vectors with their marks."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    marks: np.ndarray

    def vectors_of(self, texts: pa.Array) -> np.ndarray:
        text, place, weight = counted(texts)
        return self.project(text, place, weight, len(texts))

    def project(self, text: np.ndarray, place: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        weight = weighted(text, place, weight, n, self.idf).astype(np.float32)
        out = np.zeros((n, self.axes.shape[1]), np.float32)
        edges = np.searchsorted(text, np.arange(n + 1))
        for low in range(0, n, BLOCK):
            high = min(n, low + BLOCK)
            a, b = edges[low], edges[high]
            dense = np.zeros((high - low, WIDTH), np.float32)
            dense[text[a:b] - low, place[a:b]] = weight[a:b]
            out[low:high] = dense @ self.axes
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def votes(self, vectors: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest marked texts, each weighted by its cosine to a power; 0.5 without any. Ties go to the first voters, those with the smallest ids."""
        out = np.full(len(vectors), 0.5)
        k = min(NEAREST, len(self.marks))
        for low in range(0, len(vectors) if k else 0, BLOCK):
            cosine = np.clip(vectors[low : low + BLOCK] @ self.vectors.T, 0, 1)
            near = _largest(cosine, k)
            weight = np.take_along_axis(cosine, near, 1).astype(float) ** POWER + 1e-9
            out[low : low + BLOCK] = (weight * self.marks[near]).sum(1) / weight.sum(1)
        return out


def _largest(x: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k largest values, by place; of equal values at the edge the first."""
    n = x.shape[1]
    if k == n:
        return np.tile(np.arange(n), (len(x), 1))
    edge = np.partition(x, n - k, axis=1)[:, n - k : n - k + 1]
    level = x == edge
    room = k - (x > edge).sum(1)
    for row in np.flatnonzero(level.sum(1) > room):
        level[row, np.flatnonzero(level[row])[room[row] :]] = False
    return np.nonzero((x > edge) | level)[1].reshape(len(x), k)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray) -> Voters:
    """Voters from (places, weights) of each marked text."""
    n = len(rows)
    text = np.repeat(np.arange(n), [len(p) for p, _ in rows])
    place = np.concatenate([p for p, _ in rows]) if n else np.zeros(0, np.int64)
    weight = np.concatenate([w for _, w in rows]) if n else np.zeros(0)
    idf = np.log((n + 1) / (np.bincount(place, minlength=WIDTH) + 1)) + 0.3
    dense = np.zeros((n, WIDTH), np.float32)
    dense[text, place] = weighted(text, place, weight, n, idf)
    # leading eigenvectors of the places' products are the right singular vectors
    _, axes = np.linalg.eigh(dense.T.astype(np.float64) @ dense)
    axes = axes[:, ::-1][:, : min(DIMENSIONS, max(1, n))].astype(np.float32)
    voters = Voters(idf, axes, np.zeros((0, axes.shape[1]), np.float32), marks.astype(float))
    voters.vectors = voters.project(text, place, weight, n) if n else voters.vectors
    return voters


def train(docs: DataFrame, labels: DataFrame) -> Voters:
    """Voters from about twice ``TRAIN_ROWS`` rows, never more than twice as many: one sample in which each mark has its share of the whole table; rows with crc32(doc_id) mod 5 = 0 aren't used.

    An id votes once: of rows that share it, the one with the smallest text. The driver gets the sample's hashed terms, a few MB by the bound on ids.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~share_of("doc_id", 5, 0))
    marks: dict[int, int] = {}
    for r in sorted(bounded(usable, None, 2 * TRAIN_ROWS).collect()):
        marks.setdefault(r.doc_id, r.quality)
    sample = docs.sparkSession.createDataFrame(sorted(marks.items()), "marked_id long, quality int")
    rows = (
        docs.select(F.col("doc_id").cast("long"), "text").filter(F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES))
        .join(F.broadcast(sample), F.col("doc_id") == F.col("marked_id")).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    )

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text", SLICE):
                part = batch.slice(low, high - low)
                text, place, weight = counted(part.column("text"))
                edges = np.searchsorted(text, np.arange(len(part) + 1)).tolist()
                packed = [place[a:b].astype("<u2").tobytes() + weight[a:b].astype("<f4").tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(packed, pa.binary())], names=["doc_id", "quality", "terms"])

    found = sorted(((r.doc_id, r.quality, bytes(r.terms)) for r in rows.mapInArrow(trimmed(featured), "doc_id long, quality int, terms binary").collect()))
    terms = [(np.frombuffer(t, "<u2", len(t) // 6).astype(np.int64), np.frombuffer(t, "<f4", -1, len(t) // 6 * 2).astype(float)) for _, _, t in found]
    return fit(terms, np.array([q for _, q, _ in found], float))


def score(docs: DataFrame, labels: DataFrame, model: Voters | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of documents; predicted is 1 from ``THRESHOLD`` on.

    A null or empty text has only bands and is scored like any other. Without marked texts every
    score is 0.5. Repeated rows and null ids give a row each, an empty table none; rows aren't moved.
    An id that is marked 0 and 1 counts as 0. Voters at the same cosine count in the order of their ids.
    Other columns of the tables aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, votes in _voted(shared.value, batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(votes), pa.array((votes >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), share_of("doc_id", 5, 0).alias("held_out"), "text")
    return rows.mapInArrow(trimmed(scored), "doc_id long, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, labels: DataFrame, model: Voters | None = None) -> DataFrame:
    """The rows of documents that are predicted 1, with all their columns; one pass, nothing is moved."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, votes in _voted(shared.value, batches):
            yield part.filter(pa.array(votes >= THRESHOLD))

    return docs.mapInArrow(trimmed(kept), docs.schema)


def _voted(voters: Voters, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for low, high in slices(batch, "text", SLICE):
            part = batch.slice(low, high - low)
            yield part, voters.votes(voters.vectors_of(part.column("text")))
