"""Every input row given 50 times: the same answers, in tables that grow with the rows and not with their square."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from buildlens.llm import ivfpq, lines, minhash, neighbours, toxicity

DOCS = "doc_id long, text string"
TIMES = 50


def times(df, n=TIMES):
    return df.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("again")


@pytest.fixture
def written(monkeypatch):
    """Rows of each table that an operator saves."""
    sizes = []
    for module in (lines, minhash, ivfpq):
        real = module.saved

        def counted(df, real=real):
            out = real(df)
            sizes.append(out.count())
            return out

        monkeypatch.setattr(module, "saved", counted)
    return sizes


def corpus():
    rng = random.Random(6)
    shared = "\n".join(f"common line {k} of words that many texts hold" for k in range(12))
    rows = [(k, shared + "\n" + "\n".join(f"text {k} line {j} {rng.random()}" for j in range(8))) for k in range(6)]
    return rows + [(6, "\n".join(["one"] * 200)), (7, "\n".join(["three words here"] * 40)), (8, None), (None, shared), (None, "other " * 60)]


def test_line_dedup(spark, written):
    docs = spark.createDataFrame(corpus(), DOCS)
    want = {(r.doc_id, r.text, tuple(r.removed)) for r in lines.dedup(docs).collect()}
    once = sum(written)
    written.clear()
    got = lines.dedup(times(docs)).collect()
    assert {(r.doc_id, r.text, tuple(r.removed)) for r in got} == want and len(got) == TIMES * len(corpus())
    assert sum(written) <= once + len(corpus())


def test_near_duplicates(spark, written):
    words = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, words), (2, words + " more"), (3, words + " x y"), (3, words + " z"), (4, "alone " * 9), (5, None)], DOCS)
    want = {tuple(r) for r in minhash.duplicates(docs).collect()}
    written.clear()
    got = minhash.duplicates(times(docs)).collect()
    assert {tuple(r) for r in got} == want and len(got) == 6 * TIMES
    assert max(written) <= 48 * 6 * TIMES and sorted(written)[-2] <= 6 * TIMES + 48 * 6


def test_nearest_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = {k: rng.normal(size=8).round(3).tolist() for k in range(100)}
    rows = [(k, v) for k, v in vectors.items()] + [(20, vectors[20])] * 3 + [(40, [9.0] * 8)]
    got = {}
    for r in ivfpq.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), share=1.0, rerank=None).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 6)))
    assert set(got) == {0, 20, 40, 60, 80}
    for q, found in got.items():
        v = min(x for k, x in rows if k == q)  # one answer for an id with two vectors
        want = sorted(((-sum(a * b for a, b in zip(v, x, strict=True)), k) for k, x in rows if k != q))[:20]
        assert [(k, s) for _, k, s in sorted(found)] == [(k, round(-s, 6)) for s, k in want] and [r for r, _, _ in sorted(found)] == list(range(1, 21))
    many = ivfpq.search(times(spark.createDataFrame([(k, vectors[k]) for k in range(0, 40, 20)] + [(k, vectors[k]) for k in (1, 2)], "vec_id long, embedding array<double>"), 3)).collect()
    assert {(r.query_id, r.rank) for r in many} == {(q, k + 1) for q in (0, 20) for k in range(9)} and len(many) == 18


@pytest.mark.parametrize("operator", [neighbours, toxicity])
def test_training_is_bounded_by_ids(spark, operator, monkeypatch):
    column = "quality" if operator is neighbours else "toxic"
    docs = spark.createDataFrame([(k, f"word{k % 7} other{k % 5} text{k}") for k in range(60)], DOCS)
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(60)], f"doc_id long, {column} int")
    hot = docs.union(times(docs.filter("doc_id = 7"), 3000))
    if operator is neighbours:
        assert len(neighbours.train(hot, labels).marks) == len(neighbours.train(docs, labels).marks) <= 60
    else:
        assert toxicity._marked(hot, labels).count() == toxicity._marked(docs, labels).count() <= 60
    want = {r.doc_id: r.score for r in operator.score(docs, labels).collect()}
    got = operator.score(hot, labels).collect()
    assert len(got) == 3060 and max(abs(want[r.doc_id] - r.score) for r in got) < 1e-3  # single precision


def test_an_id_given_often_is_dealt_to_several_shards(spark, monkeypatch):
    """Every query meets all shards of a list, and the file goes through one shuffle whatever the number of queries."""
    monkeypatch.setattr(ivfpq, "SHARD_ROWS", 200)
    rng = np.random.default_rng(2)
    base = [(k, rng.normal(size=8).round(3).tolist()) for k in range(400)]
    one = spark.createDataFrame([(401, [0.5] * 8)], "vec_id long, embedding array<double>")
    got = ivfpq.search(spark.createDataFrame(base, one.schema).union(times(one, 3000)), query_modulus=2, share=1.0, rerank=None)
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 6)))
    assert set(found) == set(range(0, 400, 2))
    for q in (0, 100, 398):
        v = dict(base)[q]
        rows = [(k, x) for k, x in base if k != q] + [(401, [0.5] * 8)] * 20
        want = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), k) for k, x in rows)[:20]
        assert [(k, s) for _, k, s in sorted(found[q])] == [(k, round(-s, 6)) for s, k in want]
