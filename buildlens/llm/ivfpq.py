"""Approximate nearest neighbours by inner product: inverted file with product-quantised residuals.

Coarse centroids and, for residuals, a codebook of ``CODES`` words in each of ``PARTS`` subspaces
are fitted on a bounded sample. Every vector goes to its centroid's list with the codes of its
residual, and the file is written. Lists are packed into shards of about ``SHARD_ROWS`` rows; a list
that is longer has several shards of its own, dealt by a hash of id and place, so that one id given often is dealt too. A query ranks the lists by
the score that their best vectors may have (inner product with the centroid, and ``REACH`` times the
list's spread) and probes as many as hold ``PROBED_SHARE`` of all rows, ``LEAST_ROWS`` at least. It is
sent only to shards with such lists, and scores there only these lists' rows: by code, from its
asymmetric distance tables (inner products of its parts with all codewords), and the best ``RERANK``
of a shard exactly in double precision. The best of all shards remain.

Rows and queries of a shard meet by one sort: its rows come first and are held, its queries follow as a
stream of batches. So the file is shuffled once, whatever the number of queries, and a task holds one
shard and one batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import saved

#: Rows that training uses at most (about), rounds of k-means.
TRAIN_ROWS = 20_000
ROUNDS = 8
#: Rows a list has on average, and bounds on the number of lists: beyond the upper one lists grow, and are split over shards.
LIST_ROWS, LEAST_LISTS, MOST_LISTS = 40, 8, 2048
#: Share of all rows that a query's probed lists hold (just exceeded by the last list), and the least number of rows.
PROBED_SHARE, LEAST_ROWS = 0.47, 4096
#: Spread of a list that counts for its best vectors, in standard deviations.
REACH = 2.0
PARTS, CODES = 16, 128
#: Rows of a shard, and those of them that are scored exactly for each query.
SHARD_ROWS, RERANK = 4096, 192
#: Queries that are scored by code at once.
QUERY_BLOCK = 256
NEAREST = 20


@dataclass
class Index:
    centroids: np.ndarray
    books: np.ndarray  # parts, codes, width of a part; padded with zeros
    scales: np.ndarray  # root mean square of each list's residual parts

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Nearest centroid of each vector."""
        return _nearest(x, self.centroids)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Codes of the residuals."""
        r = _parts((x - self.centroids[lists]) / self.scales[lists, None])
        return np.stack([_nearest(r[:, p], self.books[p]) for p in range(PARTS)], axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of each query's parts with all codewords."""
        return np.einsum("qpd,pcd->qpc", _parts(q), self.books)


def _parts(x: np.ndarray) -> np.ndarray:
    d = -(-x.shape[1] // PARTS)
    return np.pad(x, ((0, 0), (0, d * PARTS - x.shape[1]))).reshape(len(x), PARTS, d)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([(half - x[i : i + 8192] @ c.T).argmin(1) for i in range(0, len(x), 8192)]) if len(x) else np.zeros(0, np.int64)


def _means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres of k-means from distinct rows; a centre that loses its rows keeps its place."""
    kinds = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = kinds[rng.choice(len(kinds), min(k, len(kinds)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, c)
        size = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


def fit(sample: np.ndarray, lists: int) -> Index:
    x = sample.astype(np.float64)
    centroids = _means(x, lists, 1)
    near = _nearest(x, centroids)
    left = x - centroids[near]
    size = np.maximum(np.bincount(near, minlength=len(centroids)), 1)
    # a dense list has small residuals: scaled, they use the same codebooks as others
    scales = np.sqrt(np.bincount(near, (left**2).mean(1), len(centroids)) / size)
    scales[scales < 1e-12] = 1e-12
    r = _parts(left / scales[near, None])
    books = np.zeros((PARTS, CODES, r.shape[2]))
    for p in range(PARTS):
        own = _means(r[:, p], CODES, 2 + p)
        books[p, : len(own)] = own
        books[p, len(own) :] = own[0]
    return Index(centroids, books, scales)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of rows that take part: an id, no null or non-finite component, not all zero, and the usual number of components."""
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    return rows.filter(F.size("v") == widths[0].w) if widths else rows


def plan(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(first shard, number of shards) of each list and the number of all shards: short lists share one, long ones have several."""
    first, many = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    shard, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        parts = -(-size // SHARD_ROWS)
        if held and (parts > 1 or held + size > SHARD_ROWS):
            shard, held = shard + 1, 0
        first[k], many[k] = shard, max(1, parts)
        shard, held = (shard + parts, 0) if parts > 1 else (shard, held + size)
    return first, many, shard + (held > 0)


def probes(index: Index, q: np.ndarray, sizes: np.ndarray, rows: int) -> np.ndarray:
    """Whether each query probes each list: those that may hold the best vectors, until they hold so many rows together."""
    hope = q @ index.centroids.T + REACH * np.linalg.norm(q, axis=1, keepdims=True) * index.scales * (sizes > 0)
    order = np.argsort(-hope, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    out = np.zeros(hope.shape, bool)
    np.put_along_axis(out, order, before < rows, 1)
    return out & (sizes > 0)


def best_of(index: Index, left: pd.DataFrame, right: pd.DataFrame, nearest: int, rerank: int | None = RERANK) -> tuple[pd.DataFrame, int]:
    """The nearest of a shard's rows (vec_id, v, list, codes) for each query (query_id, v, lists) that probes it, and the rows scored."""
    out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
    if not len(left) or not len(right):
        return out[0], 0
    left = left.sort_values(["list", "vec_id"], kind="stable")
    ids, at = left["vec_id"].to_numpy(), left["list"].to_numpy()
    codes = np.frombuffer(b"".join(left["codes"]), np.uint8).reshape(len(left), PARTS).astype(np.int64)
    x = np.stack(left["v"].to_numpy()).astype(float)
    lists, starts = np.unique(at, return_index=True)
    bounds = np.append(starts, len(at))
    take, scored = min(rerank or len(ids), len(ids)), 0
    for low in range(0, len(right), QUERY_BLOCK):
        part = right.iloc[low : low + QUERY_BLOCK]
        q_ids, q = part["query_id"].to_numpy(), np.stack(part["v"].to_numpy()).astype(float)
        wanted = np.zeros((len(q), len(lists)), bool)
        for k, own in enumerate(part["lists"]):
            wanted[k, np.searchsorted(lists, np.intersect1d(own, lists))] = True
        inner, tables = q @ index.centroids[lists].T, index.tables(q)
        rough = np.full((len(q), len(ids)), -np.inf)
        for k in range(len(lists)):
            who = np.flatnonzero(wanted[:, k])
            a, b = bounds[k], bounds[k + 1]
            if len(who):
                total = np.zeros((len(who), b - a))
                for p in range(PARTS):
                    total += tables[who, p][:, codes[a:b, p]]
                rough[who, a:b] = (total * index.scales[lists[k]] + inner[who, k : k + 1]).round(9)  # equal codes tie
                scored += len(who) * int(b - a)
        rough[q_ids[:, None] == ids[None, :]] = -np.inf
        # among ties at the edge the smaller ids are taken
        order = np.argsort(ids, kind="stable")
        rough, own_ids, own_x = rough[:, order], ids[order], x[order]
        if take < len(ids):
            edge = -np.partition(-rough, take - 1, axis=1)[:, take - 1 : take]
            above, level = rough > edge, rough == edge
            room = take - above.sum(1, keepdims=True)
            best = np.nonzero(above | (level & (np.cumsum(level, axis=1) <= room)))[1].reshape(len(q), take)
        else:
            best = np.tile(np.arange(take), (len(q), 1))
        exact = np.empty(best.shape)
        for k in range(0, len(q), 32):
            exact[k : k + 32] = (q[k : k + 32, None, :] * own_x[best[k : k + 32]]).sum(2)  # summed alike for equal vectors
        exact[np.isneginf(np.take_along_axis(rough, best, 1))] = -np.inf
        first = np.lexsort((own_ids[best], -exact), axis=1)[:, :nearest]
        score, found = np.take_along_axis(exact, first, 1), np.take_along_axis(own_ids[best], first, 1)
        there = ~np.isneginf(score)
        out.append(pd.DataFrame({"query_id": np.broadcast_to(q_ids[:, None], score.shape)[there], "vec_id": found[there], "score": score[there]}))
    return pd.concat(out), scored


def search(embeddings: DataFrame, nearest: int = NEAREST, query_modulus: int = 20, share: float = PROBED_SHARE, least_rows: int = LEAST_ROWS, rerank: int | None = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every query, by inner product, ties to the smaller vec_id.

    Queries are the rows whose id is divisible by ``query_modulus``; a query's own id is no candidate.
    Every query gets ``nearest`` rows, or all candidates where there are fewer: the probed lists hold at
    least so many besides rows with its own id. Null, zero and non-finite vectors, rows without id, and
    vectors of another width than most take no part. Repeated ids are vectors of their own as candidates; as a
    query an id is asked once, with its smallest vector (by the first component that differs). ``rerank``: rows
    of a shard that are scored exactly for a query, None for all; with ``share`` 1 the answer is then exact. An
    empty table gives no rows; columns besides vec_id and embedding aren't read.
    """
    rows = usable(embeddings)
    kind = rows.schema["v"].dataType.elementType.simpleString()
    spark = embeddings.sparkSession
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    u = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(u < max(2.0 * LEAST_LISTS, TRAIN_ROWS) / total).select("v").limit(2 * TRAIN_ROWS).toPandas()
    if not len(sample):
        sample = rows.limit(TRAIN_ROWS).select("v").toPandas()
    fitted = fit(np.stack(sample["v"].to_numpy()), int(min(MOST_LISTS, max(LEAST_LISTS, total // LIST_ROWS))))
    index = spark.sparkContext.broadcast(fitted)  # at most MOST_LISTS centroids and PARTS books

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = index.value
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["v"].to_numpy())
                at = own.assign(x)
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "v": pdf["v"], "place": np.arange(len(pdf), dtype=np.int32), "list": at.astype(np.int32), "codes": [c.tobytes() for c in own.encode(x, at)]})

    file = saved(rows.mapInPandas(placed, f"vec_id long, v array<{kind}>, place int, list int, codes binary"))
    sizes = np.zeros(len(fitted.centroids), np.int64)
    for r in file.groupBy("list").count().collect():  # a row a list
        sizes[r["list"]] = r["count"]
    first, many, _ = plan(sizes)
    asked = saved(file.filter(F.col("vec_id") % query_modulus == 0).groupBy("vec_id").agg(F.min("v").alias("v"), F.count("*").alias("many")))
    most_alike = asked.agg(F.max("many")).first()[0] or 0
    wanted_rows = max(int(np.ceil(share * total)), least_rows, nearest + most_alike)
    of_list = F.broadcast(spark.createDataFrame([(k, int(first[k]), int(many[k])) for k in range(len(sizes))], "list int, first long, many long"))  # a row a list
    home = F.col("first") + F.pmod(F.xxhash64("vec_id", "place", F.lit(7)), F.col("many"))
    held = file.join(of_list, "list").select(home.alias("shard"), F.lit(False).alias("asks"), "vec_id", "v", "list", "codes", F.lit(None).cast("array<int>").alias("lists"))

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = index.value
        for pdf in batches:
            for low in range(0, len(pdf), QUERY_BLOCK):
                block = pdf.iloc[low : low + QUERY_BLOCK]
                chosen = probes(own, np.stack(block["v"].to_numpy()).astype(float), sizes, wanted_rows)
                made: tuple[list, list, list, list] = ([], [], [], [])
                for k, (query, v) in enumerate(zip(block["vec_id"], block["v"], strict=True)):
                    lists = np.flatnonzero(chosen[k])
                    homes = np.repeat(lists, many[lists])
                    shard = np.repeat(first[lists], many[lists]) + np.arange(len(homes)) - np.repeat(np.cumsum(many[lists]) - many[lists], many[lists])
                    edges = np.flatnonzero(np.diff(shard, prepend=-1))
                    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(shard)], strict=True):
                        for column, value in zip(made, (query, v, int(shard[a]), homes[a:b].astype(np.int32)), strict=True):
                            column.append(value)
                yield pd.DataFrame(dict(zip(("vec_id", "v", "shard", "lists"), made, strict=True)))

    asks = asked.select("vec_id", "v").mapInPandas(sent, f"vec_id long, v array<{kind}>, shard long, lists array<int>")
    asks = asks.select("shard", F.lit(True).alias("asks"), "vec_id", "v", F.lit(-1).alias("list"), F.lit(None).cast("binary").alias("codes"), "lists")

    def matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, whole = -1, [], None
        for pdf in batches:
            runs = 2 * pdf["shard"].to_numpy() + pdf["asks"].to_numpy()
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(pdf)]):
                part = pdf.iloc[a:b]
                if not len(part):
                    continue
                if runs[a] // 2 != at:
                    at, parts, whole = runs[a] // 2, [], None
                if runs[a] % 2 == 0:
                    parts.append(part[["vec_id", "v", "list", "codes"]])
                elif parts:
                    whole = pd.concat(parts) if whole is None else whole
                    yield best_of(index.value, whole, part.rename(columns={"vec_id": "query_id"}), nearest, rerank)[0]

    both = held.unionByName(asks).repartition("shard").sortWithinPartitions("shard", "asks")
    found = both.mapInPandas(matched, "query_id long, vec_id long, score double")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= nearest).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
