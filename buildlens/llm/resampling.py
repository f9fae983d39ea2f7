"""Importance resampling towards a target: documents are drawn by how much likelier their n-grams are in a target than in the corpus.

Within a partition, the words of a slice of texts become ids and the suffixes of all its texts are sorted by
their first ``longest`` ids. Neighbours in that array with a longest common prefix (LCP) of k words or
more form a run, which is every occurrence of one k-gram: a run is hashed once, however often it occurs,
and its bucket is scattered back to the places of its suffixes. Counting takes the lengths of runs, scoring the scattered buckets.

What is gathered from the corpus is one count a bucket; ``buckets`` bounds the table that goes to the driver and back.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import saved
from .text import LOWER, NOT_ALNUM, per_text, raw, slices, trimmed, words

#: Bytes of text whose suffixes are sorted together.
ARRAY_BYTES = 4 << 20
#: Longest n-gram that is a feature, in words.
LONGEST = 1
BUCKETS = 10_000
#: Fewest words of a document that may be drawn.
MIN_WORDS = 20

WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def runs(codes: np.ndarray, counts: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For k = 1 to ``longest``: (suffix array, its entries at which a run begins, entries of each run); suffixes of fewer than k words are left out.

    codes: equal for equal words; counts: words of each text. No n-gram goes over the end of its text.
    """
    n = len(codes)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(n)  # words from here to the end of the text
    follow = [codes]
    for k in range(1, longest):
        follow.append(np.where(left > k, codes[np.minimum(np.arange(n) + k, n - 1)], -1))
    order = np.argsort(codes, kind="stable") if longest == 1 else np.lexsort(follow[::-1])
    same = np.ones(max(0, n - 1), bool)
    for k in range(1, longest + 1):
        column = follow[k - 1][order]
        same &= column[1:] == column[:-1]  # the LCP of these neighbours is k at least
        long_enough = left[order] >= k
        at = np.flatnonzero(long_enough)
        # suffixes that end before k words stand first among those they equal so far, so a run has no gaps
        begins = np.ones(len(at), bool)
        begins[1:] = ~same[at[1:] - 1] | ~long_enough[at[1:] - 1]
        head = np.flatnonzero(begins)
        yield order[at], head, np.diff(np.append(head, len(at)))


def bucketed(data: np.ndarray, off: np.ndarray, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For k = 1 to ``longest``: (suffixes in order of the array, bucket of each run, length of each run, words of each text)."""
    codes, distinct, counts = words(LOWER[data], off, NOT_ALNUM)
    names = distinct.to_pylist()
    crc = np.zeros(len(codes), np.int64)
    for k, (array, head, size) in enumerate(runs(codes, counts, longest)):
        first = array[head]
        # the checksum of a longer n-gram goes on from that of its first words
        heads = [zlib.crc32(b" " + names[w], c) if k else zlib.crc32(names[w]) for w, c in zip(codes[first + k].tolist(), crc[first].tolist(), strict=True)]
        found = np.array(heads, np.int64)
        crc[array] = np.repeat(found, size)
        yield array, found % buckets, size, counts


def counted(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, column: str = "text") -> DataFrame:
    """(bucket, n): features in each bucket over all rows; buckets without a feature have no row. A null text has no features."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for low, high in slices(batch, "text", ARRAY_BYTES):
                for _, bucket, size, _ in bucketed(*raw(batch.column("text").slice(low, high - low)), longest, buckets):
                    np.add.at(total, bucket, size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return texts.select(F.col(column).alias("text")).mapInArrow(trimmed(rows), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log of each bucket's smoothed share in the target over that in the corpus, rounded down; one entry a bucket."""
    sides = []
    for side in (docs, target):
        found = np.zeros(buckets)
        for r in counted(side, longest, buckets).collect():  # one row a bucket at most
            found[r.bucket] = r.n
        sides.append(found)
    s, t = sides
    total, wanted = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * total / ((a + 1) * wanted))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) for every row: the sum of the gains of its features; rows aren't moved."""
    buckets = len(gain)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text", ARRAY_BYTES):
                part = batch.slice(low, high - low)
                n_words = n_features = weight = np.zeros(part.num_rows, np.int64)
                for array, bucket, size, counts in bucketed(*raw(part.column("text")), longest, buckets):
                    own, some = np.zeros(int(counts.sum()), np.int64), np.zeros(int(counts.sum()), np.int64)
                    own[array] = np.repeat(gain[bucket], size)  # back to the occurrences
                    some[array] = 1
                    ends = np.concatenate(([0], np.cumsum(counts)))
                    n_words, n_features, weight = counts, n_features + per_text(some, ends), weight + per_text(own, ends)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n_words, n_features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(rows), WEIGHED)


def noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of seed and id; a null id counts as empty. The largest sums with it are a draw without replacement."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def numbered(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The rows with their number in this order as ``rank``, null after the first ``most``.

    A sort by ranges, written with each row's partition and place in it; the numbers of rows in the partitions before are
    added. So no task sees more than its range and only a count for each partition is gathered.
    """
    spot = F.monotonically_increasing_id()  # partition in the upper bits, place in the lower 33
    ordered = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("spot", spot))
    ordered = ordered.withColumn("part", F.shiftright("spot", 33)).withColumn("place", F.col("spot").bitwiseAND(F.lit((1 << 33) - 1)))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part").agg(F.count("*").alias("many")).select("part", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("before"))
    rank = F.col("place") + F.col("before") + 1
    ordered = ordered.join(F.broadcast(parts), "part")  # a row for each shuffle partition
    return ordered.withColumn("rank", F.when(rank <= most, rank)).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, share: int = 10, seed: int = 2024, longest: int = LONGEST, buckets: int = BUCKETS, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of documents; rank is null for those that aren't drawn.

    Features are the runs of 1 to ``longest`` consecutive words (A-Z lower-cased; what isn't an ASCII letter or digit separates,
    other characters belong to words), repeats counted. Of the N rows with at least ``least`` words, ``share`` percent, rounded
    down, are drawn: those with the highest score, ties to the smaller id (null first), then to fewer features. A null or
    empty text has no features and weight 0. Repeated rows have equal scores and are drawn one by one. An
    empty table gives no rows; with an empty target the smoothing alone makes the gains. Other columns aren't read.
    """
    scored = weighed(docs, gains(docs, target, longest, buckets), longest).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = saved(scored)
    may = F.col("n_words") >= least
    drawn = numbered(scored.filter(may), [F.col("score").desc(), F.col("doc_id").asc(), F.col("n_features").asc()], scored.filter(may).count() * share // 100)
    return drawn.union(scored.filter(~may).withColumn("rank", F.lit(None).cast("long")))


def keep(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of documents whose id is drawn, with all their columns."""
    ids = resample(docs, target, **how).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("drawn")).distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["drawn"]), "left_semi")
