"""Language identification by prediction by partial matching (PPM).

For each language a byte context tree of orders 0 to ``order`` holds symbol counts. The code
length of a byte under a language is that of PPM with escape method C: in the longest context
known to the language a seen symbol costs -log2(n / (N + U)), an unseen one pays the escape
-log2(U / (N + U)) and is coded in the next shorter context, down to eight bits below order 0
(N symbols and U distinct ones seen in the context). Statistics are frozen after training, so
a byte's code length depends on its last ``order`` bytes only. Each language's tree is an automaton
whose states are contexts; scoring looks up, for all bytes of a slice at once, the state after
their last ``order`` bytes and the code length of the byte, language by language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import bounded, per_text, raw, share_of, slices, trimmed

#: Longest context in bytes.
ORDER = 4
#: Contexts kept for each language; those rarer in it go first. Bounds the model at some 10 to 25 MB a language.
MAX_CONTEXTS = 12_000
#: Training texts for each language, and the longest one used in bytes.
TRAIN_TEXTS = 240
TRAIN_BYTES = 20_000

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


class Ppm:
    """Frozen statistics of all languages: for each an automaton over its contexts and code lengths in bits."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER, max_contexts: int = MAX_CONTEXTS):
        self.langs = sorted(texts)
        self.order = order
        seen = np.unique(np.frombuffer(b"".join(b"".join(t) for t in texts.values()), np.uint8))
        # Symbol 0 ends a text or stands for a byte that training never saw: it leaves every context.
        self.symbol = np.zeros(256, np.int64)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.size = size = len(seen) + 1
        grams = [[self._grams(texts[lang], k, size) for lang in self.langs] for k in range(order + 1)]
        repeated = self._repeated(grams, order)
        self.trees = [self._tree([grams[k][g] for k in range(order + 1)], repeated, max_contexts) for g in range(len(self.langs))]

    def _tree(self, grams: list[tuple[np.ndarray, np.ndarray]], repeated: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
        """One language's next states and code lengths, both flat by state and symbol."""
        size = self.size
        contexts = self._contexts(grams, repeated, most)
        first = np.cumsum([0] + [len(c) for c in contexts])
        states = np.zeros((first[-1], size), np.int32)
        bits = np.full((first[-1], size), 8.0, np.float32)
        for k, own in enumerate(contexts):
            at = first[k]
            if not len(own):
                break
            if k:
                shorter = first[k - 1] + np.searchsorted(contexts[k - 1], own % size ** (k - 1))
                states[at : at + len(own)] = states[shorter]
                bits[at : at + len(own)] = bits[shorter]
            if k < self.order and len(contexts[k + 1]):
                longer = contexts[k + 1]
                states[at + np.searchsorted(own, longer // size), longer % size] = first[k + 1] + np.arange(len(longer))
            gram, n = grams[k]
            context = np.searchsorted(own, gram // size)
            known = (context < len(own)) & (own[np.minimum(context, len(own) - 1)] == gram // size)
            context, gram, n = context[known], gram[known], n[known]
            total = np.bincount(context, n, len(own))
            distinct = np.bincount(context, minlength=len(own))
            used = total > 0
            rows = bits[at : at + len(own)]
            rows[used] += (np.log2((total + distinct)[used]) - np.log2(distinct[used])).astype(np.float32)[:, None]
            rows[context, gram % size] = np.log2((total + distinct)[context]) - np.log2(n)
        return states.ravel(), bits.ravel()

    def _grams(self, texts: list[bytes], k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Strings of k context symbols and one more, as numbers to the base size, with counts."""
        data = self.symbol[np.frombuffer(b"".join(t + b"\0" * (t[-1:] != b"\0") for t in texts), np.uint8)]
        if len(data) <= k:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, whole = np.zeros(len(data) - k, np.int64), np.ones(len(data) - k, bool)
        for j in range(k + 1):
            part = data[j : len(data) - k + j]
            key, whole = key * size + part, whole & (part > 0)
        return np.unique(key[whole], return_counts=True)

    def _repeated(self, grams: list, order: int) -> list[np.ndarray]:
        """Sorted contexts by order that all languages together hold at least twice."""
        found = [np.zeros(1, np.int64)]
        for k in range(1, order + 1):
            keys = np.concatenate([np.zeros(0, np.int64), *(g for g, _ in grams[k - 1])])
            counts = np.concatenate([np.zeros(0, np.int64), *(n for _, n in grams[k - 1])])
            own, place = np.unique(keys, return_inverse=True)
            found.append(own[np.bincount(place, counts, len(own)) >= 2])
        return found

    def _contexts(self, grams: list[tuple[np.ndarray, np.ndarray]], repeated: list[np.ndarray], most: int) -> list[np.ndarray]:
        """Sorted contexts of one language by order; all repeated ones that occur in it at least as often as the bound on their number allows."""
        found = [(np.zeros(1, np.int64), np.array([1 << 60]))]
        for k in range(1, len(repeated)):
            own, n = grams[k - 1]
            some = np.isin(own, repeated[k])
            found.append((own[some], n[some]))
        counts = np.sort(np.concatenate([n for _, n in found]))[::-1]
        least = int(counts[most]) + 1 if len(counts) > most else 1
        return [own[n >= least] for own, n in found]

    def code_lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Bits that each text takes in each language: an array of languages by texts."""
        d, size, n = self.order, self.size, len(off) - 1
        # order symbols 0 before each text keep contexts within it
        lengths = np.diff(off)
        place = np.arange(len(data)) + np.repeat((np.arange(n) + 1) * d, lengths)
        sym = np.zeros(len(data) + (n + 1) * d, np.int32)
        sym[place] = self.symbol[data]
        before = [sym[place - j] for j in range(d + 1)]
        out = np.zeros((len(self.trees), n))
        for g, (states, bits) in enumerate(self.trees):
            state = np.zeros(len(data), np.int32)
            for j in range(d, 0, -1):
                state = states[state * size + before[j]]
            out[g] = per_text(bits[state * size + before[0]], off)
        return out


def train(docs: DataFrame, order: int = ORDER, texts: int = TRAIN_TEXTS, longest: int = TRAIN_BYTES) -> Ppm:
    """Statistics from a bounded, hash-chosen sample of rows with text and lang whose id is not held out."""
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~share_of("doc_id", 4, 2)
        & (F.octet_length("text") <= longest) & F.col("text").rlike(r"\p{L}")
    )
    by: dict[str, list[bytes]] = {}
    for r in sorted(bounded(rows, "lang", texts).collect(), key=lambda r: (r.lang, r.doc_id, r.text)):
        by.setdefault(r.lang, []).append(r.text.encode())
    return Ppm(by, order)


def identify(docs: DataFrame, model: Ppm | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of documents.

    lang_pred is the language with the shortest code for the whole text (ties: first by name), score
    its share when each language weighs 2 to the power of minus its code length. A text that is null
    or has no letter, and any text when nothing could be learned, is ``und`` with score 0. Null ids
    are kept and count as not held out. Only doc_id, text and lang are read, lang for training alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = shared.value
        names = np.array([*ppm.langs, "und"], dtype=object)
        for batch in batches:
            for low, high in slices(batch, "text"):
                part = batch.slice(low, high - low)
                bits = ppm.code_lengths(*raw(part.column("text")))
                letters = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                if len(ppm.langs):
                    best = bits.argmin(0)
                    score = 1.0 / np.exp2(np.clip(bits.min(0) - bits, -1000, 0)).sum(0)
                else:
                    best, score = np.zeros(len(part), np.int64), np.zeros(len(part))
                best, score = np.where(letters, best, len(ppm.langs)), np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names[best], pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long"), share_of("doc_id", 4, 2).alias("held_out"), "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return rows.mapInArrow(trimmed(scored), SCHEMA)
