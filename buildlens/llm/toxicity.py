"""Toxicity by a classifier chain of linear models.

Terms are lower-case words and their first ``PREFIXES`` characters. Those that a bounded sample of
marked rows holds more often in toxic texts than chance allows become features: present in the
whole text or not. The terms are grouped into categories by the texts that share them. The chain's
links are logistic models, one for each category (a toxic text with a term of that group) and a
last one for the mark itself; each link also gets the earlier links' probabilities, for training
those that models fitted without the row's fold predict.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, NOT_ALNUM, bounded, raw, share_of, slices, trimmed, words

#: Marked rows that training uses, for each of the two marks on average, and the longest of their texts in bytes.
TRAIN_ROWS = 2000
TRAIN_BYTES = 60_000
#: Most terms, least texts and least standard deviations above chance of a term.
TERMS, LEAST_TEXTS, LEAST_Z = 192, 3, 4.5
PREFIXES = (4, 5, 6)
CATEGORIES = 3
FOLDS = 5
RIDGE = 1.0
SLICE = 8 << 20


def terms_of(word: bytes) -> list[str]:
    """A word and its prefixes; a prefix is marked so that it differs from the same word."""
    text = word.decode(errors="replace")
    return [text, *(text[:k] + "*" for k in PREFIXES if len(text) > k)]


def _words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    data, off = raw(texts)
    codes, distinct, counts = words(LOWER[data], off, NOT_ALNUM)
    return codes, distinct.to_pylist(), counts


def present(texts: pa.Array, terms: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) pairs, each once, of the terms that stand in the texts."""
    codes, distinct, counts = _words(texts)
    hits = [(c, terms[t]) for c, w in enumerate(distinct) for t in terms_of(w) if t in terms]
    if not hits or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, term = np.array(hits, np.int64).T
    some = np.zeros(len(distinct), bool)
    some[code] = True
    text = np.repeat(np.arange(len(counts)), counts)
    at = some[codes]
    pairs = np.unique(text[at] * len(distinct) + codes[at])
    text, own = pairs // len(distinct), pairs % len(distinct)
    first, many = np.searchsorted(code, own), np.searchsorted(code, own, "right") - np.searchsorted(code, own)
    index = np.repeat(first, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    both = np.unique(np.repeat(text, many) * len(terms) + term[index])
    return both // len(terms), both % len(terms)


def tallies(texts: pa.Array, toxic: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(terms, texts with each, toxic ones among these)."""
    codes, distinct, counts = _words(texts)
    n = max(1, len(counts))
    own = [terms_of(w) for w in distinct]
    place, terms = pd.factorize(np.array([t for ts in own for t in ts], dtype=object))
    first = np.concatenate(([0], np.cumsum([len(ts) for ts in own], dtype=np.int64)))
    pairs = np.unique(codes * n + np.repeat(np.arange(len(counts)), counts))
    word, text = pairs // n, pairs % n
    many = first[word + 1] - first[word]
    index = np.repeat(first[word], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    both = np.unique(place[index] * n + np.repeat(text, many))
    term, text = both // n, both % n
    size = len(terms)
    return list(terms), np.bincount(term, minlength=size), np.bincount(term, toxic[text], size).astype(np.int64)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last is the intercept, which isn't shrunk."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    shrink = np.full(len(w), RIDGE)
    shrink[-1] = 1e-3
    for _ in range(rounds):
        p = sigmoid(a @ w)
        slope = a.T @ (p - y) + shrink * w
        curve = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(shrink)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Chain:
    """Terms by place and the links' weights; a link's weights end with those of earlier links and an intercept."""

    terms: dict[str, int]
    groups: np.ndarray
    links: list[np.ndarray]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """One column a link, categories first and the mark last."""
        out = np.zeros((len(x), 0))
        for w in self.links:
            out = np.hstack([out, sigmoid(np.hstack([x, out]) @ w[:-1] + w[-1])[:, None]])
        return out


def _groups(x: np.ndarray, k: int) -> np.ndarray:
    """Groups of terms by cosine of the texts that hold them: k centres, each first farthest from those before."""
    v = x.T / np.maximum(np.linalg.norm(x.T, axis=1, keepdims=True), 1e-9)
    if len(v) <= k:
        return np.arange(len(v))
    centres = [0]
    for _ in range(k - 1):
        centres.append(int((v @ v[centres].T).max(1).argmin()))
    c = v[centres]
    for _ in range(10):
        group = (v @ c.T).argmax(1)
        c = np.stack([v[group == g].sum(0) if (group == g).any() else c[g] for g in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return (v @ c.T).argmax(1)


def solid(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which terms these rows alone would choose: in enough texts, and in toxic ones far above chance."""
    n, share = x.sum(0), toxic.mean() if len(toxic) else 0.0
    spread = np.sqrt(np.maximum(n * share * (1 - share), 1e-12))
    return (n >= LEAST_TEXTS) & ((x.T @ toxic - n * share) / spread >= LEAST_Z)


def chain(x: np.ndarray, toxic: np.ndarray, fold: np.ndarray, terms: dict[str, int], categories: int = CATEGORIES) -> Chain:
    """Fits the links in turn; a link learns from out-of-fold probabilities of the earlier ones.

    The model for a fold's probabilities sees nothing of the fold: it uses only terms that the other rows choose.
    """
    groups = _groups(x[toxic == 1], categories) if len(terms) else np.zeros(0, np.int64)
    targets = [toxic * (x[:, groups == g].sum(1) > 0) for g in range(categories)] + [toxic]
    links, held = [], np.zeros((len(x), 0))
    for y in targets:
        own = np.hstack([x, held])
        links.append(fit(own, y))
        out = np.zeros(len(x))
        for f in range(FOLDS):
            inside = fold != f
            used = np.append(solid(x[inside], toxic[inside]), np.ones(held.shape[1], bool))
            w = fit(own[inside][:, used], y[inside]) if inside.any() else np.zeros(used.sum() + 1)
            out[~inside] = sigmoid(own[~inside][:, used] @ w[:-1] + w[-1])
        held = np.hstack([held, out[:, None]])
    return Chain(terms, groups, links)


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the training sample. The marks that are joined are bounded in number, so they're broadcast; an id that rows share teaches once, by its smallest text."""
    usable = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~share_of("doc_id", 5, 0))
    marks: dict[int, int] = {}
    for r in sorted(bounded(usable, None, 2 * TRAIN_ROWS).collect()):
        marks[r.doc_id] = max(r.toxic, marks.get(r.doc_id, 0))
    sample = docs.sparkSession.createDataFrame(sorted(marks.items()), "marked_id long, toxic int")
    return (
        docs.select(F.col("doc_id").cast("long"), "text").filter(F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES))
        .join(F.broadcast(sample), F.col("doc_id") == F.col("marked_id")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    )


def train(docs: DataFrame, labels: DataFrame) -> Chain:
    """A chain from at most about twice ``TRAIN_ROWS`` marked rows, one sample in which each mark has its share of the whole table; rows with crc32(doc_id) mod 5 = 0 aren't used."""
    sample = _marked(docs, labels)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text", SLICE):
                part = batch.slice(low, high - low)
                terms, n, toxic = tallies(part.column("text"), part.column("toxic").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(n), pa.array(toxic)], names=["term", "n", "toxic"])

    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    if not 0 < share < 1:
        return Chain({}, np.zeros(0, np.int64), [np.array([-30.0 if not share else 30.0])])
    z = (F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    chosen = (
        sample.mapInArrow(trimmed(counted), "term string, n long, toxic long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        .filter(F.col("n") >= LEAST_TEXTS).withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(TERMS).collect()
    )
    terms = {r.term: k for k, r in enumerate(chosen)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text", SLICE):
                part = batch.slice(low, high - low)
                text, term = present(part.column("text"), terms)
                off = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.ListArray.from_arrays(pa.array(off), pa.array(term.astype(np.int32)))], names=["doc_id", "toxic", "terms"])

    rows = sorted(sample.mapInArrow(trimmed(held), "doc_id long, toxic int, terms array<int>").collect())
    x = np.zeros((len(rows), len(terms)))
    for k, r in enumerate(rows):
        x[k, r.terms] = 1
    toxic = np.array([r.toxic for r in rows], float)
    return chain(x, toxic, np.array([crc32(str(r.doc_id).encode()) // 5 % FOLDS for r in rows]), terms)


def score(docs: DataFrame, labels: DataFrame, model: Chain | None = None) -> DataFrame:
    """(doc_id, held_out, categories, score, predicted) for every row of documents.

    categories holds the earlier links' probabilities, score that of the mark; predicted is 1 from
    0.5 on. A null or empty text has no terms and gets the chain's base probability. With marks of
    one kind only, or none, that kind is predicted for all (none: 0). Repeated rows and null ids
    give a row each, an empty table none; rows aren't moved. An id that is marked 0 and 1 counts as 1.
    Marks and ids serve training alone; other columns aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for low, high in slices(batch, "text", SLICE):
                part = batch.slice(low, high - low)
                x = np.zeros((len(part), len(own.terms)))
                if own.terms:
                    x[present(part.column("text"), own.terms)] = 1
                p = own.probabilities(x)
                many = p.shape[1] - 1
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * many, pa.int32()), pa.array(p[:, :-1].ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), lists, pa.array(p[:, -1]), pa.array((p[:, -1] >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "categories", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), share_of("doc_id", 5, 0).alias("held_out"), "text")
    return rows.mapInArrow(trimmed(scored), "doc_id long, held_out boolean, categories array<double>, score double, predicted int")
