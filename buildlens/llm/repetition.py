"""Quality rules on repetition within a text, from a suffix array over its words.

All texts of a slice are handled at once. Prefix doubling ranks the suffixes of every text by
their first 1, 2, 4, ... words; suffixes whose rank is unique leave, so the work follows what
repeats. The ranks of all rounds then give the longest common prefix (LCP) of suffixes that are
neighbours in the suffix array: the larger LCP of a suffix with its two neighbours is the length
of the longest repeated substring that starts there. It is part of a maximal repeat if the
suffix one word earlier doesn't repeat by one word more. The spans of the maximal repeats are
united into a covered share of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import BLANK, coded, per_text, raw, slices, spans, trimmed

#: Words in the windows of the base rule, and the shortest repeat that counts as covered.
WINDOW = 8
#: Fewest words of a kept text.
MIN_WORDS = 20
#: Most of the words that may stand in repeated windows (base rule), in percent.
MAX_REPEATED = 30
#: Most of the words that maximal repeats may cover.
MAX_COVERED = 0.3
#: Longest repeat that a kept text may have, as a share of its words, when longer than MIN_LONGEST words.
MAX_LONGEST = 0.15
MIN_LONGEST = 24

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
VERDICT = "base_failed boolean, n_maximal_repeats long, covered_words long, longest_repeat long, kept boolean"
SCHEMA = f"doc_id long, {COUNTS}, {VERDICT}"

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: First bytes of UTF-8 characters.
HEAD = (np.arange(256) & 0xC0) != 0x80


def repeats(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length in words of the longest substring starting at each word that occurs elsewhere in its text.

    codes: equal for equal words; counts: words of each text. Occurrences may overlap.
    """
    n = len(codes)
    longest = np.zeros(n, np.int64)
    if not n:
        return longest
    text = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    active, key, step = np.arange(n), text * (int(codes.max()) + 1) + codes, 1
    parent = np.zeros(n, np.int64)
    rank = np.zeros(n, np.int64)
    ranks: list[np.ndarray] = []
    while len(active):
        # A group's rank is the place in the suffix array of its first suffix.
        order = np.argsort(key, kind="stable")
        ordered, above = key[order], parent[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(order)))
        opened = np.concatenate(([True], above[1:] != above[:-1]))
        within = head - np.flatnonzero(opened)[np.cumsum(opened)[head] - 1]
        rank = rank.copy()
        rank[active[order]] = np.repeat(above[head] + within, size)
        ranks.append(rank)
        active = np.sort(active[order[np.repeat(size > 1, size)]])
        parent, beyond = rank[active], active + step
        follow = np.where(beyond < end[active], rank[np.minimum(beyond, n - 1)] + 1, 0)
        key, step = parent * (n + 2) + follow, 2 * step
    # Neighbours in the suffix array; their LCP, by the rounds in which they have one rank, longest first.
    array = np.argsort(rank)
    a, b = array[:-1].copy(), array[1:].copy()
    near = np.flatnonzero(ranks[0][a] == ranks[0][b])
    first, second = a[near], b[near]
    a, b, lcp = first.copy(), second.copy(), np.zeros(len(near), np.int64)
    for r in range(len(ranks) - 1, -1, -1):
        same = (a < n) & (b < n)
        same &= ranks[r][np.minimum(a, n - 1)] == ranks[r][np.minimum(b, n - 1)]
        step = same.astype(np.int64) << r
        lcp, a, b = lcp + step, a + step, b + step
    longest[first] = lcp
    longest[second] = np.maximum(longest[second], lcp)
    return longest


def covered(longest: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(words in the union of maximal repeats of at least ``least`` words, number of such repeats' spans) by text."""
    n = len(longest)
    start = np.zeros(n, bool)
    if n:
        first = np.cumsum(counts) - counts
        head = np.zeros(n, bool)
        head[first[counts > 0]] = True
        start = longest >= least
        start[1:] &= head[1:] | (longest[:-1] <= longest[1:])  # else it only continues the span before
    at = np.flatnonzero(start)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    off = np.concatenate(([0], np.cumsum(counts)))
    return per_text((np.cumsum(edge[:-1]) > 0).astype(np.int64), off), per_text(start.astype(np.int64), off)


def windows(longest: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Words of each text in windows of this width that occur twice or more in it."""
    n = len(longest)
    at = np.flatnonzero(longest >= width)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return per_text((np.cumsum(edge[:-1]) > 0).astype(np.int64), np.concatenate(([0], np.cumsum(counts))))


def duplicate_lines(text: str | None) -> int:
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measured(texts: pa.Array) -> dict[str, np.ndarray]:
    """The columns of COUNTS and VERDICT for these texts."""
    data, off = raw(texts)
    _, kept, lengths, counts = spans(data, off)
    codes, _ = coded(kept, lengths)
    longest = repeats(codes, counts)
    words_off = np.concatenate(([0], np.cumsum(counts)))
    covered_words, maximal = covered(longest, counts, WINDOW)
    peak = np.zeros(len(counts), np.int64)
    some = counts > 0
    if some.any():
        peak[some] = np.maximum.reduceat(longest, words_off[:-1][some])
    repeated = windows(longest, counts, WINDOW)
    failed = (counts < MIN_WORDS) | (100 * repeated > MAX_REPEATED * counts)
    long_one = (peak >= MIN_LONGEST) & (peak > MAX_LONGEST * counts)
    return {
        "n_words": counts, "word_chars": per_text((HEAD & ~BLANK)[data].view(np.int8), off), "n_symbols": per_text(SYMBOL[data].view(np.int8), off),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts.to_pylist()], np.int64), "n_repeat_words": repeated, "base_failed": failed,
        "n_maximal_repeats": maximal, "covered_words": covered_words, "longest_repeat": peak,
        "kept": ~failed & ~long_one & (covered_words <= MAX_COVERED * counts),
    }


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, verdict) for every row of documents, see COUNTS and VERDICT.

    A null or empty text has no words and fails the base rule. Rows aren't moved; repeated rows and
    null ids give a row each. Only doc_id and text are read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text"):
                part = batch.slice(low, high - low)
                found = measured(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(v) for v in found.values())], names=["doc_id", *found])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(rows), SCHEMA)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of documents that the rules keep, with all their columns; one pass, nothing is moved."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text"):
                part = batch.slice(low, high - low)
                yield part.filter(pa.array(measured(part.column("text"))["kept"]))

    return docs.mapInArrow(trimmed(rows), docs.schema)
