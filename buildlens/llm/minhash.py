"""Near-duplicate documents by b-bit MinHash, with every link confirmed on whole shingle sets.

A document's set holds its distinct runs of five words. Equal sets form a class at once, by a
digest of the set. For each class ``BANDS`` x ``ROWS`` of ``HASHES`` minima give band keys; of each minimum four
low bits are kept, packed as bit planes. Documents that share a band key are candidates:

1. In each bucket the class with the smallest id is compared with all others of the bucket.
2. Links of step 1 make components. In buckets that still hold several, every member outside the
   bucket's largest component is compared with all members of other components. The join on the
   bucket estimates similarity itself and emits a plausible pair once, from the first band it shares.

So every candidate pair is either compared or already connected, and a bucket of n similar
documents costs about n comparisons. A pair is compared on whole sets if the similarity estimated
from equal low bits, corrected for chance collisions, is at most four standard deviations below the
threshold. With 48 bands of 6 rows a pair at the threshold is missed with probability 1e-4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import saved
from .text import LOWER, raw, slices, trimmed, words

SHINGLE = 5
#: Linked from so many percent of the union on.
PERCENT = 75
BANDS, ROWS = 48, 6
#: Minima in all: those of the bands, and more that only sharpen the estimate.
HASHES = 768
BITS = 4
#: Standard deviations that the estimate of a pair at the threshold may fall short by.
SLACK = 4
#: Most bits of the filter on ids that the second pass over texts uses.
FILTER_BITS = 1 << 27
#: 64-bit words of a bit plane.
PLANE = -(-HASHES // 64)

_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = _RNG.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SKETCH = "doc_id long, n_shingles long, x long, y long, bands array<long>, planes array<long>"


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of each text's distinct shingles, rising within a text; n + 1 offsets)."""
    data, off = raw(texts)
    codes, distinct, counts = words(LOWER[data], off)
    n = len(counts)
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], np.uint64)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    word = hashed[codes]
    first = np.cumsum(counts) - counts
    many = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    text = np.repeat(np.arange(n), many)
    at = np.repeat(first, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    size = np.minimum(counts, SHINGLE)[text]
    value = np.zeros(len(at), np.uint64)
    last = len(word) - 1
    for j in range(SHINGLE):
        value += np.where(j < size, word[np.minimum(at + j, last)] * _PLACE[j], np.uint64(0))
    value = mixed(value + size.astype(np.uint64))
    order = np.argsort(value)
    order = order[np.argsort(text[order].astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")]
    value, text = value[order], text[order]
    new = np.concatenate(([True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])))
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(n + 1))


def minima(value: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Least value of each text's shingles under each hash function: texts by functions; no text may be empty."""
    out = np.empty((HASHES, len(off) - 1), np.uint64)
    for k, factor in enumerate(_FACTORS):
        out[k] = np.minimum.reduceat(value * factor, off[:-1])
    return out.T


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, band keys, bit planes) of every row; empty sets have no keys."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text"):
                part = batch.slice(low, high - low)
                value, off = shingles(part.column("text"))
                size = np.diff(off)
                some = np.flatnonzero(size)
                x, y = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
                keys, planes = np.zeros((0, BANDS), np.uint64), np.zeros((0, BITS * PLANE), np.int64)
                if len(some):
                    starts = off[:-1][some]
                    x[some], y[some] = _digest(value, starts)
                    least = minima(value, np.append(starts, len(value)))
                    keys = mixed((least[:, : BANDS * ROWS].reshape(len(some), BANDS, ROWS) * _ROW).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                    low_bits = mixed(least, 3)
                    packed = []
                    for b in range(BITS):
                        bits = np.zeros((len(some), PLANE * 64), np.uint8)
                        bits[:, :HASHES] = (low_bits >> np.uint64(b)).astype(np.uint8) & 1
                        packed.append(np.packbits(bits, axis=1).view(np.int64))
                    planes = np.hstack(packed)

                def lists(made, width, size=size):
                    bounds = np.concatenate(([0], np.cumsum((size > 0) * width)))
                    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(made.view(np.int64).ravel()))

                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size), pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), lists(keys, BANDS), lists(planes, BITS * PLANE)],
                    names=["doc_id", "n_shingles", "x", "y", "bands", "planes"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(rows), SKETCH)


def _filter(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap of the ids' hashes, a Bloom filter with one function; its size is bounded, beyond that it only passes more."""
    wanted = 64 * max(1, ids.count())
    size = min(FILTER_BITS, 1 << max(16, wanted.bit_length()))
    spots = ids.select(F.pmod(F.xxhash64("first_id"), F.lit(size)).alias("spot"))
    rows = spots.groupBy(F.expr("spot div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, int(spot % 64)))").alias("bits")).toPandas()
    bitmap = np.zeros(size // 64, np.int64)
    bitmap[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bitmap, size


def _digest(value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits (as two numbers) of each set of shingles that begins at one of the places."""
    return np.add.reduceat(mixed(value, 1), starts), np.bitwise_xor.reduceat(mixed(value, 2), starts)


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) of these nodes (node, first_id, x), read from the documents; a filter of bounded size keeps other texts from being moved."""
    nodes = saved(nodes)
    bitmap, size = _filter(nodes)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = batch.column("spot").to_numpy()
            batch = batch.filter(pa.array((shared.value[spot // 64] >> (spot % 64)) & 1 == 1))
            for low, high in slices(batch, "text"):
                part = batch.slice(low, high - low)
                value, off = shingles(part.column("text"))
                some = np.flatnonzero(np.diff(off))
                if len(some):
                    sets = pa.ListArray.from_arrays(pa.array(np.append(off[:-1][some], off[-1]), pa.int32()), pa.array(value.view(np.int64)))
                    x, _ = _digest(value, off[:-1][some])
                    yield pa.RecordBatch.from_arrays([part.column("first_id").take(pa.array(some)), pa.array(x.view(np.int64)), sets], names=["first_id", "x", "set"])

    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").filter("first_id IS NOT NULL").withColumn("spot", F.pmod(F.xxhash64("first_id"), F.lit(size)))
    return texts.mapInArrow(trimmed(rows), "first_id long, x long, set array<long>").join(nodes, ["first_id", "x"]).select("node", "set")


def _estimate(p: Column, q: Column) -> Column:
    """Similarity from equal low bits, corrected for bits that are equal by chance."""
    unequal = F.lit(0)
    for w in range(PLANE):
        either = p[w].bitwiseXOR(q[w])
        for b in range(1, BITS):
            either = either.bitwiseOR(p[b * PLANE + w].bitwiseXOR(q[b * PLANE + w]))
        unequal = unequal + F.bit_count(either)
    chance = 0.5**BITS
    return (1 - unequal / F.lit(float(HASHES)) - chance) / (1 - chance)


def _least_estimate() -> float:
    """So many standard deviations of the estimate below the threshold."""
    chance, share = 0.5**BITS, PERCENT / 100
    equal = chance + (1 - chance) * share
    return share - SLACK * (equal * (1 - equal) / HASHES) ** 0.5 / (1 - chance)


def _plausible(pa_: str, pb: str, na: str, nb: str) -> Column:
    return (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)) & (_estimate(F.col(pa_), F.col(pb)) >= _least_estimate())


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets overlap enough. The second's set moves to the first's, once a pair."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = saved(_sets(docs, ends.join(nodes.select("node", "first_id", "x"), "node")))
    if not sets.groupBy("node").count().filter("count > 1").isEmpty():  # rows that are given several times
        sets = saved(sets.dropDuplicates(["node"]))
    # one lead may have a third of all pairs: no aggregate stands on its key, so adaptive execution can split it
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("t")), "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("s")), "a")
    common = F.size(F.array_intersect("s", "t"))
    return both.filter(100 * common >= PERCENT * (F.size("s") + F.size("t") - common)).select("a", "b")


def _links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) of nodes that are linked with another."""
    members = nodes.select(F.posexplode("bands").alias("band", "key"), "node")
    leads = members.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("many")).filter("many > 1").select("key", "lead")
    members = saved(members.join(leads, "key"))
    facts = nodes.select("node", "n_shingles", "planes")

    def near(pairs: DataFrame) -> DataFrame:
        of = lambda end: facts.select(F.col("node").alias(end), F.col("n_shingles").alias(f"n{end}"), F.col("planes").alias(f"p{end}"))
        return pairs.join(of("b"), "b").join(of("a"), "a").filter(_plausible("pa", "pb", "na", "nb")).select("a", "b")

    stars = saved(members.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())
    found = components(confirmed(docs, nodes, saved(near(stars))))
    # buckets with several components
    placed = members.join(found, "node", "left").select("key", "band", "node", "lead", F.coalesce("component", "node").alias("component"))
    sizes = placed.groupBy("key", "component").count()
    largest = sizes.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("count", -F.col("component"))).alias("main")).filter("parts > 1").select("key", "main")
    # the lead has been compared with everyone; sketches move along, so that a pair is judged where it is made
    open_ = saved(placed.filter("node <> lead").join(largest, "key").drop("lead").join(nodes.select("node", "n_shingles", "bands", "planes"), "node"))
    outside = open_.filter("component <> main").select("key", *(F.col(c).alias(f"{c}_u") for c in ("node", "component", "n_shingles", "bands", "planes")))
    others = F.expr("component_u <> component AND (component = main OR node_u < node)")
    first_shared = F.expr("array_position(zip_with(bands, bands_u, (p, q) -> p = q), true) = band + 1")
    across = saved(
        open_.join(outside, (open_["key"] == outside["key"]) & others & _plausible("planes", "planes_u", "n_shingles", "n_shingles_u") & first_shared)
        .select(F.least("node_u", "node").alias("a"), F.greatest("node_u", "node").alias("b"))
    )
    if across.isEmpty():
        return found
    more = confirmed(docs, nodes, across)
    of = found.select("node", "component")
    ends = (
        more.join(of.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(of.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    merged = components(ends).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    alone = merged.select(F.col("component").alias("node"), "whole").join(found, "node", "left_anti").select("node", F.col("whole").alias("component"))
    return found.join(merged, "component", "left").select("node", F.coalesce("whole", "component").alias("component")).union(alone)


def _named(classes: DataFrame) -> DataFrame:
    """The classes with a number ``node`` of their own: the smallest id, and a hash for those that share theirs with another class."""
    shared = classes.groupBy("first_id").agg(F.count("*").alias("many")).filter("many > 1").select("first_id", F.lit(True).alias("shared"))
    if shared.isEmpty():
        return classes.withColumn("node", F.col("first_id"))
    return saved(classes.join(shared, "first_id", "left").withColumn("node", F.when(F.col("shared"), F.xxhash64("x", "y")).otherwise(F.col("first_id"))).drop("shared"))


def duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of documents.

    Words are separated by space, tab and line ends, A-Z count as a-z. Fewer than five words are one
    shingle; without words (or text) the set is empty and the row is linked with nothing. component_id
    is the smallest id reachable over links, kept says whether it is the row's own. Repeated rows give
    a row each. Rows that share an id but not the text are each judged by their own text, and never
    linked by the id alone. A row without id gets the component of documents with an equal set, null
    without any, and isn't kept. An empty table gives no rows; columns besides doc_id and text aren't read.
    """
    base = saved(sketch(docs))
    classes = (
        base.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("x", "y")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("planes").alias("planes"))
    )
    nodes = _named(saved(classes))
    linked = saved(_links(docs, nodes))
    firsts = linked.join(nodes.select("node", "first_id"), "node")
    ids = saved(firsts.groupBy("component").agg(F.min("first_id").alias("least_id")))
    least = firsts.join(ids, "component").select("node", "least_id")
    whole = nodes.join(least, "node", "left").select("x", "y", F.coalesce("least_id", "first_id").alias("component_id"))
    own = base.select("doc_id", "n_shingles", "x", "y")
    some = own.filter("n_shingles > 0").join(whole, ["x", "y"], "left").select("doc_id", "n_shingles", "component_id")
    none = own.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.union(none).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of documents of which ``duplicates`` keeps the id, with all their columns; rows without id stay.

    Rows that share an id stay or go together: they stay if any of them is kept, so no text is lost
    that has no copy elsewhere. Columns of any other name are passed on as they are. An empty table gives no rows.
    """
    spare = "_" * (1 + max(map(len, docs.columns), default=0))  # longer than any column of the table
    judged = duplicates(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    gone = judged.filter("NOT kept").select(F.col("doc_id").alias(spare))
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(spare), "left_anti")
