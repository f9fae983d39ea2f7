"""Order-preserving packing of token sequences into windows by dynamic programming.

The documents of a partition form a stream of tokens in their order. A window is a run of at most
``capacity`` tokens; its end costs nothing between documents, ``SENTENCE_CUT`` tokens after a
sentence and ``HARD_CUT`` elsewhere, and its padding costs a token each. A window whose length is a
power of two isn't padded. With f(j) the least cost up to the cut j at position p(j),

    f(j) = penalty(j) + min of capacity - p(j) + f(i) + p(i) over cuts i with p(j) - p(i) <= capacity,
                           and f(i) over cuts i with p(j) - p(i) a power of two.

As p grows the first minimum moves over a sliding window: a monotone queue finds it in constant
amortised time. The second has a few cuts at most. Where sentences are long, cuts within them are allowed every ``GRID`` tokens.

Streams are solved a segment of ``SEGMENT`` tokens at a time; a segment's last window goes on into
the next, so only the last window of a partition has more padding than its cuts ask for; it is cut
into powers of two where that is cheaper. A row is
never moved to another partition, and memory holds one segment or one document.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .subwords import byte_bpe
from .text import raw, slices, trimmed

CAPACITY = 1024
SENTENCE_CUT = 4
HARD_CUT = 12
GRID = 24
#: Shortest window that the search leaves without padding as a power of two.
LEAST_POWER = 64
SEGMENT = 1 << 19
#: Text that is tokenised at once, in bytes.
SLICE = 8 << 20

PIECE = "doc_id long, start long, length long, {}, doc_tokens long, sequence_id long, offset long"
SCHEMA_IDS = PIECE.format("ids array<int>")
SCHEMA_DIGEST = PIECE.format("ids_crc32 long")


def cuts(positions: np.ndarray, penalties: np.ndarray, capacity: int = CAPACITY, least_power: int = LEAST_POWER) -> list[int]:
    """Places in ``positions`` (rising, none over capacity apart, from 0) that end windows on the cheapest way to the last."""
    whole: dict[int, list[tuple[int, int]]] = {}  # cuts a power of two before
    power = least_power
    while power < capacity:
        at = np.minimum(np.searchsorted(positions, positions - power), len(positions) - 1)
        for j in np.flatnonzero(positions[at] == positions - power).tolist():
            whole.setdefault(j, []).append((int(at[j]), power))
        power *= 2
    pos, pen = positions.tolist(), penalties.tolist()
    n = len(pos)
    back = [0] * n
    value = [0] * n  # f(i) + p(i)
    value[0] = pos[0]
    queue: deque[int] = deque([0])
    for j in range(1, n):
        p = pos[j]
        low = p - capacity
        while pos[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        v = value[i] + capacity
        if j in whole:
            for k, power in whole[j]:
                if value[k] + power < v:
                    i, v = k, value[k] + power
        back[j] = i
        v += pen[j]
        value[j] = v
        while queue and value[queue[-1]] > v:
            queue.pop()
        queue.append(j)
    way, j = [], n - 1
    while j:
        way.append(j)
        j = back[j]
    return way[::-1]


def in_powers(length: int) -> list[int]:
    """The powers of two that add up to the length, largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def candidates(ends: np.ndarray, sentences: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts from 0 to total and their penalties: documents' ends, sentences' ends, and a grid in wide gaps."""
    penalty = np.full(total + 1, -1, np.int32)
    penalty[sentences] = SENTENCE_CUT
    penalty[ends] = 0
    penalty[[0, total]] = 0
    at = np.flatnonzero(penalty >= 0)
    gap = np.diff(at)
    wide = np.flatnonzero(gap > GRID)
    if len(wide):
        more = (gap[wide] - 1) // GRID
        first = np.cumsum(more) - more
        extra = np.repeat(at[wide], more) + GRID * (np.arange(int(more.sum())) - np.repeat(first, more) + 1)
        penalty[extra] = HARD_CUT
        at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


class Stream:
    """Tokens that are not yet in a window, and the windows so far."""

    def __init__(self, first_sequence: int, capacity: int):
        self.sequence, self.capacity = first_sequence, capacity
        self.ids: list[np.ndarray] = []
        self.ends_sentence: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, tokens, place of its first token (below 0: some are gone)
        self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray, ends_sentence: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids), self.total))
        self.ids.append(ids)
        self.ends_sentence.append(ends_sentence)
        self.total += len(ids)

    def flush(self, last: bool) -> list[tuple]:
        """Pieces (doc_id, start, ids, doc_tokens, sequence_id, offset) of all windows, or all but the last, which stays."""
        if not self.total:
            return []
        ids, marks = np.concatenate(self.ids), np.concatenate(self.ends_sentence)
        begin = np.array([d[2] for d in self.docs], np.int64)
        at, penalty = candidates(np.append(begin[begin > 0], self.total), np.flatnonzero(marks) + 1, self.total)
        way = at[cuts(at, penalty, self.capacity)]
        edges = np.concatenate(([0], way if last else way[:-1]))
        if last:
            parts = in_powers(int(edges[-1] - edges[-2]))
            if HARD_CUT * (len(parts) - 1) < self.capacity - sum(parts):
                edges = np.concatenate((edges[:-1], edges[-2] + np.cumsum(parts)))
        done = int(edges[-1])
        breaks = np.unique(np.concatenate((edges, begin[(begin > 0) & (begin < done)])))
        doc = np.searchsorted(begin, breaks[:-1], "right") - 1
        window = np.searchsorted(edges, breaks[:-1], "right") - 1
        out = []
        for a, b, d, w in zip(breaks[:-1].tolist(), breaks[1:].tolist(), doc.tolist(), window.tolist(), strict=True):
            doc_id, tokens, first = self.docs[d]
            out.append((doc_id, a - first, ids[a:b], tokens, self.sequence + w, a - int(edges[w])))
        self.sequence += len(edges) - 1
        rest = [(i, n, p - done) for i, n, p in self.docs if p + n > done]
        self.ids, self.ends_sentence, self.docs, self.total = [ids[done:]], [marks[done:]], rest, self.total - done
        return out


def _batch(pieces: list[tuple], digest: bool) -> pa.RecordBatch:
    doc_id, start, ids, tokens, sequence, offset = zip(*pieces, strict=True)
    lengths = np.array([len(x) for x in ids], np.int64)
    if digest:
        name, held = "ids_crc32", pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())
    else:
        name, held = "ids", pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, long), pa.array(start, long), pa.array(lengths), held, pa.array(tokens, long), pa.array(sequence, long), pa.array(offset, long)],
        names=["doc_id", "start", "length", name, "doc_tokens", "sequence_id", "offset"],
    )


def sentence_ends(tokenizer) -> np.ndarray:
    """For each id, whether its token ends a sentence: a full stop, exclamation or question mark, or a line feed."""
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():
        ends[i] = token[-1:] in (".", "!", "?") or "Ċ" in token
    return ends


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, digest: bool = False) -> DataFrame:
    """Pieces of every row's tokens in windows of at most ``capacity`` tokens.

    A document is the ids of its whole text (null: none) and ``end_id``; each id lies in exactly one
    piece, and pieces of a sequence follow each other from offset 0 without gaps. ``digest`` gives
    crc32 of the little-endian 32-bit ids in place of the ids. Sequence ids are the partition's number
    times 2^33 and a running number, so they don't depend on other partitions; a partition that is
    computed again gives the same pieces. Repeated rows and null ids are packed as rows of their own, an
    empty text is its ``end_id`` alone, an empty table gives no rows. Only doc_id and text are read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer_path)
        ends = sentence_ends(encoder.tokenizer)
        stream = Stream(TaskContext.get().partitionId() << 33, capacity)
        for batch in batches:
            for low, high in slices(batch, "text", SLICE):
                part = batch.slice(low, high - low)
                ids, off = encoder(*raw(part.column("text")))
                marks = ends[ids]
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                    stream.add(doc_id, np.append(ids[a:b], np.uint32(end_id)), np.append(marks[a:b], True))
                    if stream.total >= SEGMENT and (pieces := stream.flush(False)):
                        yield _batch(pieces, digest)
        if pieces := stream.flush(True):
            yield _batch(pieces, digest)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(rows), SCHEMA_DIGEST if digest else SCHEMA_IDS)
