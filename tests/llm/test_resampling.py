import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from buildlens.llm import resampling, text

DOCS = "doc_id long, text string, bucket long, n long, rank long, spot long"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(t, longest):
    ws = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    return len(ws), [b" ".join(ws[i : i + k]) for k in range(1, longest + 1) for i in range(len(ws) - k + 1)]


def brute(docs, target, share, longest, buckets=10_000, least=20):
    count = lambda texts: Counter(zlib.crc32(g) % buckets for t in texts for g in grams(t, longest)[1])
    s, t = count(d for _, d in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for i, d in docs:
        n, found = grams(d, longest)
        weight = sum(gain(zlib.crc32(g) % buckets) for g in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    drawn = [(*r, k + 1 if k < len(may) * share // 100 else None) for k, r in enumerate(may)]
    return drawn + [(*r, None) for r in rows if r[1] < least]


def corpus():
    rng = random.Random(9)
    some = ["Alpha", "beta", "gamma", "ДЕЛЬТА", "e5", "日本"]
    return [(k, " ".join(rng.choice(some) + rng.choice(["", "", "-", "\n"]) for _ in range(rng.randint(0, 70)))) for k in range(160)] + [
        (None, "no id " * 12), (500, None), (501, ""), (502, " ?! "), (503, "copy text " * 20), (503, "copy text " * 20), (504, "word " * 60_000)]


@pytest.mark.parametrize(("share", "longest"), [(10, 1), (55, 3), (100, 2), (0, 1)])
def test_draws_match_brute_force(spark, share, longest):
    docs, target = corpus(), ["alpha beta alpha", "E5 日本 e5", None]
    table = spark.createDataFrame([(*d, 1, 2, 3, 4) for d in docs], DOCS).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resampling.resample(table, wanted, share=share, longest=longest).collect()]
    assert sorted(got, key=repr) == sorted(brute(docs, target, share, longest), key=repr)


def test_empty_sides_and_whole_rows(spark):
    table = spark.createDataFrame([(*d, 1, 2, 3, 4) for d in corpus()], DOCS)
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(table.limit(0), none).count() == 0
    assert resampling.resample(table, none).count() == len(corpus())
    left = resampling.keep(table, none, share=50)
    ids = {r.doc_id for r in resampling.resample(table, none, share=50).filter("rank is not null").collect()}
    assert left.columns == table.columns and {r.doc_id for r in left.collect()} == ids


def test_runs_are_all_occurrences_of_each_gram():
    rng = random.Random(3)
    for _ in range(150):
        texts = [[rng.randrange(3) for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(1, 4))]
        codes, counts = np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts])
        for k, (array, head, size) in enumerate(resampling.runs(codes, counts, 4), 1):
            want, at = {}, 0
            for t in texts:
                for i in range(len(t) - k + 1):
                    want.setdefault(tuple(t[i : i + k]), set()).add(at + i)
                at += len(t)
            ends = [*head[1:].tolist(), len(array)] if len(head) else []
            got = [set(array[a:b].tolist()) for a, b in zip(head.tolist(), ends, strict=True)]
            assert sorted(map(sorted, got)) == sorted(map(sorted, want.values())) and size.sum() == len(array)


def test_a_run_is_hashed_once(monkeypatch):
    calls = []
    real = zlib.crc32
    monkeypatch.setattr(resampling.zlib, "crc32", lambda *a: calls.append(1) or real(*a))
    list(resampling.bucketed(*text.raw(pa.array(["a b a b a b", "b a"])), 2, 100))
    assert len(calls) == 4  # a, b, a b, b a


def test_numbers_go_on_from_range_to_range(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40), k) for k in range(3000)]
    found = resampling.numbered(spark.createDataFrame(rows, "score long, doc_id long"), [resampling.F.col("score").desc(), resampling.F.col("doc_id").asc()], 2000)
    got = {r.doc_id: r["rank"] for r in found.collect()}
    for k, (_, i) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1):
        assert got[i] == (k if k <= 2000 else None)
